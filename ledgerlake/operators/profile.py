"""Data-quality profiles as DataFrames (one aggregation pass each)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import has_edge_whitespace, has_text, strip
from ..functions.web import preview
from .dedup import first_per_key


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def profile_key(df: DataFrame, key: str) -> DataFrame:
    """Rows, NULL keys and duplicated keys: rows beyond the first of each key, NULL being one key too."""
    n, nulls = F.count(F.lit(1)), F.count(F.lit(1)) - F.count(key)
    keys = F.count_distinct(key) + F.least(nulls, F.lit(1))
    return df.agg(n.alias("n"), nulls.alias("null_keys"), (n - keys).alias("dup_keys"))


def sheet_counts(cells: DataFrame) -> DataFrame:
    """Per workbook sheet: cells that hold a value or a formula, and those with a formula."""
    held = F.col("value").isNotNull() | F.col("formula").isNotNull()
    return cells.groupBy("path", "sheet").agg(F.count_if(held).alias("non_empty"), F.count("formula").alias("formulas"))


def profile_measures(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Zero and negative counts per measure: one pass, then one row per measure."""
    aggs = []
    for m in measures:
        aggs += [F.count_if(F.col(m) == 0).alias(f"{m}__zeros"),
                 F.count_if(F.col(m) < 0).alias(f"{m}__negatives")]
    wide = df.agg(*aggs, F.count(F.lit(1)).alias("__n"))
    rows = [F.struct(F.lit(m).alias("col"), F.col(f"{m}__zeros").alias("zeros"),
                     F.col(f"{m}__negatives").alias("negatives"), F.col("__n").alias("n"))
            for m in measures]
    return wide.select(F.inline(F.array(*rows)))


def negative_positions(df: DataFrame, measures: Sequence[str], key) -> DataFrame:
    """Where the negative values are: ``key..., col, value``."""
    rows = [F.struct(F.lit(m).alias("col"), F.col(m).cast("double").alias("value")) for m in measures]
    return df.select(*_list(key), F.inline(F.array(*rows))).filter(F.col("value") < 0)


def profile_whitespace(df: DataFrame, name, by) -> DataFrame:
    """Per group: values that ``strip`` would change, and all values."""
    c = F.col(name) if isinstance(name, str) else name
    return df.groupBy(*_list(by)).agg(F.count_if(has_edge_whitespace(c)).alias("dirty"),
                                      F.count(F.lit(1)).alias("n"))


def profile_whitespace_arrays(df: DataFrame, values: str, by) -> DataFrame:
    """``profile_whitespace`` over an array column (e.g. the text nodes of a page):
    counted per row with array functions, so the row's other columns are never
    copied into one row per element, then summed per group."""
    arr = F.col(values)
    per_row = df.select(*_list(by), F.size(F.filter(arr, has_edge_whitespace)).alias("_dirty"),
                        F.size(arr).alias("_n"))
    return per_row.groupBy(*_list(by)).agg(F.sum("_dirty").cast("long").alias("dirty"),
                                           F.sum("_n").cast("long").alias("n"))


def dirty_values(df: DataFrame, name: str, key=()) -> DataFrame:
    """The values themselves (with their ``key`` columns) next to their stripped form."""
    return df.filter(has_edge_whitespace(F.col(name))).select(*_list(key), name,
                                                              strip(F.col(name)).alias("stripped"))


def dirty_values_in_arrays(df: DataFrame, values: str, key=(), pos_col: str = "pos",
                           value_col: str = "value") -> DataFrame:
    """``dirty_values`` over an array column: elements are indexed and filtered
    inside the array, so only the dirty ones become rows (0-based ``pos``)."""
    indexed = F.transform(F.col(values), lambda x, i: F.struct(i.alias(pos_col), x.alias(value_col)))
    dirty = F.filter(indexed, lambda s: has_edge_whitespace(s[value_col]))
    return (df.select(*_list(key), F.inline(dirty))
            .select(*_list(key), pos_col, value_col, strip(F.col(value_col)).alias("stripped")))


def classify_density(df: DataFrame, report, order: str, text: str, *, sample_rows: int | None = None,
                     usable_min_rows: int = 2, preview_chars: int | None = None) -> DataFrame:
    """Per report: rows that hold text, ``sparse`` when at most
    ``usable_min_rows`` do, and the first text (by ``order``). A caller may ask
    for a look at the first ``sample_rows`` rows only, or for a cut text.
    """
    report = _list(report)
    sampled = df if sample_rows is None else first_per_key(df, report, [F.col(order).asc()], k=sample_rows)
    has_data = F.coalesce(has_text(F.col(text)), F.lit(False))
    agg = sampled.groupBy(*report).agg(
        F.count_if(has_data).alias("rows_with_data"),
        F.min_by(F.when(has_data, F.col(text)), F.when(has_data, F.col(order))).alias("_first"))
    return agg.select(*report, "rows_with_data",
                      (F.col("rows_with_data") <= usable_min_rows).alias("sparse"),
                      preview(F.col("_first"), preview_chars).alias("first_cell_text"))


def density_summary(classified: DataFrame) -> DataFrame:
    """How many reports are usable vs sparse."""
    return classified.agg(F.count_if(~F.col("sparse")).alias("usable"),
                          F.count_if(F.col("sparse")).alias("sparse"))


def holds_fd(df: DataFrame, lhs, rhs: str) -> DataFrame:
    """Functional dependency ``lhs -> rhs``: distinct rhs values per lhs, and whether it is 1."""
    return df.groupBy(*_list(lhs)).agg(F.count_distinct(rhs).alias("n_values")) \
        .withColumn("holds", F.col("n_values") == 1)


def reconcile(stated: DataFrame, children: DataFrame, key, value: str, *, tolerance: float = 0.0,
              stated_col: str = "stated", children_col: str = "children") -> DataFrame:
    """Stated subtotal vs the sum of its children, per key; a key that one side lacks does not match."""
    key = _list(key)
    kids = children.groupBy(*key).agg(F.sum(value).alias(children_col))
    st = stated.select(*key, F.col(value).alias(stated_col))
    out = st.join(kids, key, "full")
    diff = F.abs(F.col(stated_col) - F.col(children_col))
    match: Column = (F.col(stated_col) == F.col(children_col)) if tolerance == 0 else (diff <= tolerance)
    return out.withColumn("matches", F.coalesce(match, F.lit(False)))


def classify_sheet_density(cells: DataFrame, inventory: DataFrame, *, sample_rows: int | None = None,
                           usable_min_rows: int = 2, preview_chars: int | None = None) -> DataFrame:
    """Per workbook sheet: rows holding at least one cell (within the first
    ``sample_rows`` rows, if given), ``sparse`` when at most ``usable_min_rows``
    do, and the first cell of any type in reading order. Sheets without any cell
    (from the ``inventory``) are listed with 0 rows.

    The row filter reaches the scan; cells are first reduced to one row per
    sheet row (partial aggregation), then to one row per sheet.
    """
    sample = cells if sample_rows is None else cells.filter(F.col("row_idx") < sample_rows)
    per_row = sample.groupBy("path", "sheet", "row_idx").agg(
        F.min_by("value", F.when(F.col("value").isNotNull(), F.col("col_idx"))).alias("_text"))
    per_sheet = per_row.groupBy("path", "sheet").agg(
        F.count(F.lit(1)).alias("rows_with_data"),
        F.min_by("_text", F.when(F.col("_text").isNotNull(), F.col("row_idx"))).alias("_first"))
    out = inventory.select("path", "sheet_index", "sheet").join(per_sheet, ["path", "sheet"], "left")
    rows = F.coalesce(F.col("rows_with_data"), F.lit(0)).cast("long")
    return out.select("path", "sheet_index", "sheet", rows.alias("rows_with_data"),
                      (rows <= usable_min_rows).alias("sparse"),
                      preview(F.col("_first"), preview_chars).alias("first_cell_text"))

