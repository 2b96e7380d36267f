"""Surrogate keys, natural -> surrogate key resolution, insert-if-absent.

Replaces sequences, unique indexes and ``ON CONFLICT DO NOTHING`` with joins:
an anti join finds the absent rows, an append writes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, path_exists
from .dedup import dedup
from .joins import lookup_join


FEW_NAMES = 10_000   # parent names that are broadcast


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def assign_keys(candidates: DataFrame, nk, key_col: str,
                existing: DataFrame | None = None) -> DataFrame:
    """Give every natural key not yet in ``existing`` the next integer key.

    Keys follow natural-key order and continue after ``max(existing.key_col)``;
    existing keys never change. Distributed: the distinct keys are range
    partitioned and sorted, each partition numbers its rows locally, and a
    prefix sum over the (few) per-partition counts gives the offsets - no
    single-partition window over the whole dimension. The numbered partitions
    are checkpointed to the shared checkpoint folder so a lost executor cannot
    re-partition them differently between the count and the numbering.
    """
    keys = _keys(nk)
    spark = candidates.sparkSession
    new = candidates.select(*keys).distinct()
    base = F.lit(0).cast("long")
    if existing is not None:
        new = new.join(existing.select(*keys), keys, "left_anti")
        base = existing.select(F.coalesce(F.max(key_col), F.lit(0)).cast("long")).scalar()

    checkpoint_dir(spark)
    numbered = (new.repartitionByRange(*keys)
                .sortWithinPartitions(*keys)
                .select(*keys,
                        F.spark_partition_id().alias("_pid"),
                        F.monotonically_increasing_id().alias("_mid"))
                .checkpoint(eager=True))
    # _mid = (partition id << 33) + position within the partition.
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    # One row per partition: the broadcast is bounded by the partition count.
    return (numbered.join(F.broadcast(offsets), "_pid")
            .select((base + F.col("_off") + local + F.lit(1)).cast("long").alias(key_col), *keys))


def resolve_key(df: DataFrame, dim: DataFrame, on, key: str, *, nullable: bool = False,
                label: str | None = None) -> DataFrame:
    """Add ``dim.key`` by joining on natural key(s) ``on``.

    ``nullable=False``: every row must resolve; an unresolved key fails the job
    (``raise_error`` inside the plan - no extra pass over the data). The
    planner broadcasts a dimension whose bytes allow it.
    """
    on = _keys(on)
    out = lookup_join(df, dim.select(*on, key), on, "left")
    if nullable:
        return out
    msg = F.concat(F.lit(f"unresolved {label or key} for "), F.concat_ws("|", *[F.col(c).cast("string") for c in on]))
    return out.withColumn(key, F.coalesce(F.col(key), F.raise_error(msg).cast("long")).cast("long"))


def resolve_optional_key(df: DataFrame, dim: DataFrame, nk_col: str, dim_nk: str, key: str,
                         out: str) -> DataFrame:
    """Self-dimension lookup (parent): NULL text -> NULL key; non-NULL text must resolve.

    Only the distinct names are looked up. If there are few (counted, up to
    ``FEW_NAMES``) they are broadcast to the dimension, which is then scanned but
    not shuffled; else both sides are shuffled.
    """
    names = df.select(nk_col).filter(F.col(nk_col).isNotNull()).distinct()
    few = names.limit(FEW_NAMES + 1).count() <= FEW_NAMES
    d = dim.select(F.col(dim_nk).alias(nk_col), F.col(key).alias(out))
    held = d.join(F.broadcast(names) if few else names, nk_col, "left_semi")
    joined = df.join(F.broadcast(held), nk_col, "left") if few else lookup_join(df, held, nk_col, "left")
    bad = F.col(nk_col).isNotNull() & F.col(out).isNull()
    return joined.withColumn(
        out, F.when(bad, F.raise_error(F.concat(F.lit("unresolved parent "), F.col(nk_col))).cast("long"))
        .otherwise(F.col(out)))


def absent_rows(target: DataFrame, incoming: DataFrame, nk, ordinal=None) -> DataFrame:
    """Rows of ``incoming`` whose natural key is not in ``target``.

    In-batch duplicates are settled first (smallest ``ordinal`` wins, like a
    row-by-row insert loop with ``DO NOTHING``); across batches the first load
    wins because existing keys are never replaced.
    """
    keys = _keys(nk)
    if ordinal is not None:
        incoming = dedup(incoming, keys, ordinal, keep="first")
    return incoming.join(target.select(*keys), keys, "left_anti")


def insert_if_absent(target: DataFrame, incoming: DataFrame, nk, ordinal=None) -> DataFrame:
    """The target after the load: existing rows plus the absent incoming rows."""
    return target.unionByName(absent_rows(target, incoming, nk, ordinal))


def append_if_absent(incoming: DataFrame, path: str, nk, ordinal=None, fmt: str = "parquet",
                     partition_by=None) -> int:
    """Append the absent rows to the table stored at ``path``; returns rows written.

    Re-running with the same input appends nothing (replay-safe).
    """
    spark = incoming.sparkSession
    target = spark.read.format(fmt).load(path) if path_exists(spark, path) else None  # None: the first load
    new = incoming if target is None else absent_rows(target, incoming, nk, ordinal)
    if target is None and ordinal is not None:
        new = dedup(incoming, _keys(nk), ordinal, keep="first")
    new = new.cache()
    try:
        n = new.count()
        if n:
            w = new.write.mode("append").format(fmt)
            if partition_by:
                w = w.partitionBy(*_keys(partition_by))
            w.save(path)
    finally:
        new.unpersist()
    return n


def in_known(df: DataFrame, known: DataFrame, on, flag: str = "is_known") -> DataFrame:
    """Flag rows whose key occurs in ``known`` (EXISTS), without duplicating rows."""
    on = _keys(on)
    k = known.select(*on).distinct().withColumn(flag, F.lit(True))
    return lookup_join(df, k, on, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def not_in_known(df: DataFrame, known: DataFrame, on) -> DataFrame:
    return df.join(known.select(*_keys(on)), _keys(on), "left_anti")
