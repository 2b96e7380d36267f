"""Hierarchies of any depth given as (node, parent) rows: levels, ancestors, leaf sums, violations.

Ancestor paths are found by pointer doubling: in every round each unfinished
node appends the path of the farthest ancestor it knows, so a hierarchy of depth
``d`` takes ``log2(d)`` joins instead of ``d``. A round that finishes no node
proves that those left run into a cycle: above any other node there would be one
at most twice as deep as the finished ones. Rounds are checkpointed; the lookup
side holds only nodes that are the end of some path, the many children of one
parent are spread by adaptive skew splitting. A path costs its depth in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .joins import lookup_join

CYCLE = "cycle"
MISSING_PARENT = "missing_parent"


def ancestors(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """``node, parent, path`` (ancestors, nearest first), ``level`` (0: root), ``root`` and ``problem``.

    ``problem`` is ``missing_parent`` for a node whose parent has no row (it counts
    as a root) and ``cycle`` for nodes on or below a cycle (path, level and root are
    NULL); else NULL. Rows without a node are left out; of several rows of a node
    the smallest non-NULL parent counts (uniqueness is a check of its own).
    """
    checkpoint_dir(nodes.sparkSession)
    n = nodes.filter(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min(parent).alias("parent"))
    known = n.select(F.col("node").alias("parent"), F.lit(True).alias("_known"))
    state = lookup_join(n, known, "parent", "left")
    nothing = F.array().cast(f"array<{n.schema['node'].dataType.simpleString()}>")
    state = state.select(
        "node", "parent", F.when(F.col("_known"), F.array("parent")).otherwise(nothing).alias("path"), F.col("_known").isNull().alias("done"),
        F.when(F.col("parent").isNotNull() & F.col("_known").isNull(), F.lit(MISSING_PARENT)).alias("problem")).checkpoint(eager=True)
    left = state.filter(~F.col("done")).count()
    while left:
        end = F.element_at("path", -1)
        ends = state.filter(~F.col("done")).select(end.alias("node")).distinct()
        above = state.join(ends, "node", "left_semi").select(F.col("node").alias("_end"), F.col("path").alias("_path"), F.col("done").alias("_done"))
        moving = lookup_join(state.filter(~F.col("done")).withColumn("_end", end), above, "_end").select(
            "node", "parent", F.concat("path", "_path").alias("path"), F.col("_done").alias("done"), "problem")
        state = state.filter("done").unionByName(moving).checkpoint(eager=True)
        now = state.filter(~F.col("done")).count()
        if now == left:
            break
        left = now
    done = F.col("done")
    return state.select(
        "node", "parent", F.when(done, F.col("path")).alias("path"), F.when(done, F.size("path")).alias("level"),
        F.when(done, F.coalesce(F.try_element_at("path", F.lit(-1)), F.col("node"))).alias("root"),
        F.when(~done, F.lit(CYCLE)).otherwise(F.col("problem")).alias("problem"))


def violations(found: DataFrame) -> DataFrame:
    """The nodes of ``ancestors`` on or below a cycle, and those whose parent is missing."""
    return found.filter(F.col("problem").isNotNull()).select("node", "parent", "problem")


def leaf_sums(found: DataFrame, values: DataFrame, value: str, node: str = "node") -> DataFrame:
    """``node, level, is_leaf, n_leaves, total``: the leaves below every node (itself, if it is one) and their sum of ``value``.

    Inner nodes' own values don't count: a stated subtotal is never added to its
    parts. Nodes of a cycle are left out; leaves without a value count as NULL.
    Each leaf gives one row per ancestor, partially aggregated before the shuffle.
    """
    tree = found.filter(F.col("level").isNotNull())
    inner = tree.filter(F.col("parent").isNotNull()).select(F.col("parent").alias("node")).distinct().withColumn("_inner", F.lit(True))
    marked = lookup_join(tree, inner, "node", "left").select("node", "level", "path", F.col("_inner").isNull().alias("is_leaf"))
    own = values.groupBy(F.col(node).alias("node")).agg(F.sum(value).alias("_value"))
    leaves = lookup_join(marked.filter("is_leaf"), own, "node", "left")
    total = leaves.select(F.explode(F.concat(F.array("node"), F.col("path"))).alias("node"), "_value").groupBy("node").agg(
        F.count(F.lit(1)).alias("n_leaves"), F.sum("_value").alias("total"))
    return marked.select("node", "level", "is_leaf").join(total, "node")
