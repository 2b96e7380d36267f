"""Wide -> long unpivot, hierarchy rollup, share of total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import col
from .joins import lookup_join


def wide_to_long(df: DataFrame, ids: Sequence[str], groups: Sequence[tuple[str, str, bool]],
                 measures: Sequence[str], *, name_col: str = "group_name",
                 leaf_col: str = "is_leaf", sep: str = "_") -> DataFrame:
    """Unpivot several measures per group at once.

    ``groups`` is ``[(prefix, name, is_leaf), ...]``; the wide frame holds
    ``{prefix}{sep}{measure}``. Every wide row becomes ``len(groups)`` long rows
    ``ids + [name_col, leaf_col] + measures``. A ``Generate`` (inline of an
    array of structs) inside the same stage - no shuffle.
    """
    rows = [
        F.struct(F.lit(name).alias(name_col), F.lit(bool(leaf)).alias(leaf_col),
                 *[F.col(f"{prefix}{sep}{m}").alias(m) for m in measures])
        for prefix, name, leaf in groups
    ]
    return df.select(*ids, F.inline(F.array(*rows)))


def rollup_levels(df: DataFrame, parent: str, leaf: str, value, *, value_out: str = "headcount",
                  total_label: str = "ALL", name_col: str = "category_name",
                  level_col: str = "hierarchy_level", parent_col: str = "parent_category",
                  leaf_col: str = "is_leaf") -> DataFrame:
    """Grand total (level 0), one subtotal per parent (level 1) and the leaves
    (level 2), each with its parent's name and a leaf flag - the rows a
    report states pre-computed. ``GROUPING SETS ((parent, leaf), (parent), ())``.
    """
    g = (df.rollup(parent, leaf)
         .agg(F.sum(col(value)).cast("long").alias(value_out),
              F.grouping(parent).alias("_gp"), F.grouping(leaf).alias("_gl")))
    is_total = F.col("_gp") == 1
    is_sub = F.col("_gl") == 1
    return g.select(
        F.when(is_total, F.lit(total_label)).when(is_sub, F.col(parent)).otherwise(F.col(leaf)).alias(name_col),
        F.when(is_total, 0).when(is_sub, 1).otherwise(2).alias(level_col),
        F.when(is_total, F.lit(None).cast("string")).when(is_sub, F.lit(total_label))
        .otherwise(F.col(parent)).alias(parent_col),
        (F.col("_gl") == 0).alias(leaf_col),
        F.col(value_out),
    )


def share_of_total(df: DataFrame, value: str, *, total: Column | None = None, by: Sequence[str] | None = None,
                   out: str = "share_pct", digits: int | None = 6,
                   total_rows: Column | None = None) -> DataFrame:
    """``value / total * 100`` (NULL when the total is 0).

    Without ``by`` the total is one number: a scalar subquery (computed once,
    inlined as a constant - no join). With ``by`` (many reports at once) the
    per-report totals are joined on the report key. ``total_rows`` selects the
    row(s) carrying the stated total (e.g. ``level == 0``); default sums ``value``.
    """
    v = F.col(value).cast("double")
    if by:
        src = df.filter(total_rows) if total_rows is not None else df
        agg = F.max(value) if total_rows is not None else F.sum(value)
        totals = src.groupBy(*by).agg(agg.cast("double").alias("_total"))
        out_df = lookup_join(df, totals, list(by), "left")
        t = F.col("_total")
        pct = F.when(t != 0, v / t * 100.0)
        if digits is not None:
            pct = F.round(pct, digits)
        return out_df.withColumn(out, pct).drop("_total")
    if total is None:
        src = df.filter(total_rows) if total_rows is not None else df
        agg = F.max(value) if total_rows is not None else F.sum(value)
        total = src.select(agg.cast("double")).scalar()
    t = total.cast("double")
    pct = F.when(t != 0, v / t * 100.0)
    if digits is not None:
        pct = F.round(pct, digits)
    return df.withColumn(out, pct)
