"""Connected components by alternating large-star and small-star steps; no node's links meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.store import checkpointed


def _nearest(links: DataFrame) -> DataFrame:
    """a, b and m, the smaller of a and the least b of a."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(least.select("a", F.least("a", "m").alias("m")), "a")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _nearest(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    near = _nearest(down)
    return near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        near.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node above has one link, to a node without any of its own."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.where("up + down > 1").limit(1).count()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of every linked node but the components' least ones."""
    links = checkpointed(spark, links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while not _settled(links):
        links = checkpointed(spark, _small_star(_large_star(links)))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def merged(spark: SparkSession, labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (of ``components``) once ``links`` (a, b) are added: only components that these join are linked anew."""
    for end in ("a", "b"):
        of = labels.select(F.col("node").alias(end), F.col("component").alias("comp"))
        links = links.join(of, end, "left").withColumn(end, F.coalesce("comp", end)).drop("comp")
    joined = components(spark, links)
    if not joined.limit(1).count():
        return labels
    above = joined.select(F.col("node").alias("component"), F.col("component").alias("comp"))
    moved = labels.join(above, "component", "left").select("node", F.coalesce("comp", "component").alias("component"))
    return checkpointed(spark, moved.union(joined))
