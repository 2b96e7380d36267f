"""Positional operators over the cell table.

The cell table is ``(report columns..., row_idx, col_idx, value)`` with one row
per non-empty cell - what the workbook scan emits. Layouts (which columns
mean what, which row ranges are totals/subtotals/leaves, which header texts
must be present) are configuration in the plan itself, or tables: one layout for
all reports or one per report, however many.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as sc
from .intervals import range_join
from .joins import lookup_join


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def table_cells(df: DataFrame, report, row: str, columns: Sequence[str]) -> DataFrame:
    """Melt a row-shaped table into cells: ``columns[i]`` becomes ``col_idx = i``.

    NULL values produce no cell (a sparse grid, like a sheet).
    """
    report = _list(report)
    cells = [F.struct(F.lit(i).alias("col_idx"), F.col(c).cast("string").alias("value"))
             for i, c in enumerate(columns)]
    return (df.select(*report, F.col(row).alias("row_idx"), F.inline(F.array(*cells)))
            .filter(F.col("value").isNotNull()))


def layout_columns(spark, mapping: Mapping[str, int]) -> DataFrame:
    """``{field: col_idx}`` -> DataFrame(col_idx, field)."""
    return spark.createDataFrame([(int(i), f) for f, i in mapping.items()], "col_idx int, field string")


def layout_rows(spark, ranges: Sequence[tuple]) -> DataFrame:
    """``[(level, row_start, row_end, parent_row), ...]`` (inclusive bounds)."""
    return spark.createDataFrame(
        [(int(l), int(s), int(e), None if p is None else int(p)) for l, s, e, p in ranges],
        "hierarchy_level int, row_start int, row_end int, parent_row int")


def grid_slice(df: DataFrame, start: int, end: int, row: str = "row_idx") -> DataFrame:
    """Keep rows ``start..end`` inclusive (drops titles, headers, totals, notes)."""
    return df.filter(F.col(row).between(start, end))


def report_extent(df: DataFrame, report, row: str = "row_idx") -> DataFrame:
    """Last used row per report (partial aggregation; one row per report)."""
    return df.groupBy(*_list(report)).agg(F.max(row).alias("last_row"))


def slice_between_header_and_total(df: DataFrame, report, row: str = "row_idx",
                                   header_rows: int = 1) -> DataFrame:
    """Data rows of every report: after ``header_rows`` leading rows and before
    the report's last row (its total row). Bounds are per report, read from the
    data, so reports of different length are sliced correctly."""
    report = _list(report)
    ext = report_extent(df, report, row)
    return (lookup_join(df, ext, report)
            .filter(F.col(row).between(F.lit(header_rows), F.col("last_row") - 1))
            .drop("last_row"))


def expected_rows(reports: DataFrame, report, ranges: Sequence[tuple], row: str = "row_idx") -> DataFrame:
    """Every (report, row) a layout announces, whether the sheet holds it or not.

    ``ranges`` are inclusive ``(first, last)`` pairs of integers or of columns of
    ``reports`` (bounds per report); a pair whose last is below its first, or
    NULL, announces nothing.
    """
    spans = []
    for first, last in ranges:
        a, b = (x if isinstance(x, Column) else F.lit(int(x)) for x in (first, last))
        spans.append(F.when(a <= b, F.sequence(a.cast("long"), b.cast("long"))).otherwise(F.array().cast("array<long>")))
    return reports.select(*_list(report), F.explode(F.array_distinct(F.flatten(F.array(*spans)))).alias(row))


def missing_rows(reports: DataFrame, cells: DataFrame, report, ranges: Sequence[tuple], row: str = "row_idx") -> DataFrame:
    """Announced rows of which the report holds no cell with a text (blank cells count as none).

    The cells are reduced to distinct rows before the shuffle, so their number
    per row (or a hot report's size) doesn't matter to the anti join.
    """
    keys = [*_list(report), row]
    held = cells.filter(sc.blank_to_null("value").isNotNull()).select(*keys).distinct()
    return expected_rows(reports, report, ranges, row).join(held, keys, "left_anti")


def records_from_cells(cells: DataFrame, layout, fields: Sequence[str], report,
                       row: str = "row_idx", rows: Sequence[tuple] | None = None) -> DataFrame:
    """Cells -> one record per report row with a column per layout field.

    ``rows`` (inclusive ranges) makes the result dense: exactly those rows of
    every report in ``cells``, a row without cells as a record of NULLs. The
    announced rows join the cells' own aggregation as empty cells, so this
    costs no further shuffle of the cells.

    ``layout`` is ``{field: col_idx}`` (configuration: the cells are filtered to
    the configured columns and pivoted directly on ``col_idx``, no join) or a
    layout table ``(col_idx, field)``, with report columns if reports differ
    (joined by equality; Spark broadcasts a small one). Either way the
    pivot is a single conditional aggregation on ``(report, row)`` with an
    explicit field list: one shuffle, partial aggregation.
    """
    report = _list(report)
    if rows is not None:
        inside = F.lit(False)
        for first, last in rows:
            inside = inside | F.col(row).between(int(first), int(last))
        empty = expected_rows(cells.select(*report).distinct(), report, rows, row)
        empty = empty.select(*report, F.col(row).cast(cells.schema[row].dataType).alias(row), F.lit(None).cast("int").alias("col_idx"),
                             F.lit(None).cast("string").alias("value"))
    if isinstance(layout, DataFrame):
        own = [c for c in report if c in layout.columns]
        picked = cells.join(layout.select(*own, "col_idx", "field"), [*own, "col_idx"])
        if rows is not None:
            picked = picked.filter(inside).unionByName(empty.withColumn("field", F.lit(None).cast("string")), allowMissingColumns=True)
        return picked.groupBy(*report, row).agg(
            *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])
    wanted = {f: int(layout[f]) for f in fields}
    picked = cells.filter(F.col("col_idx").isin(sorted(set(wanted.values()))))
    if rows is not None:
        picked = picked.filter(inside).unionByName(empty, allowMissingColumns=True)
    return picked.groupBy(*report, row).agg(
        *[F.max(F.when(F.col("col_idx") == i, F.col("value"))).alias(f) for f, i in wanted.items()])


def tag_sections(rows: DataFrame, layout, report, name: str, row: str = "row_idx",
                 *, level_col: str = "hierarchy_level", parent_col: str = "parent_category",
                 leaf_col: str = "is_leaf", leaf_level: int = 2) -> DataFrame:
    """Tag every row with its hierarchy level from the layout's row ranges and
    resolve its parent's name (the row named by ``parent_row``) per report.

    ``layout`` is either the ranges themselves, ``[(level, first, last,
    parent_row), ...]`` - turned into a ``CASE WHEN`` projection, no join - or
    a layout table of any size, interval-joined by buckets; if it has the report
    columns, every report has ranges of its own. Rows outside every range are
    dropped. The parent's name comes from a lookup join on ``(report, row)``.
    """
    report = _list(report)
    if isinstance(layout, DataFrame):
        own = report if set(report) <= set(layout.columns) else []
        lay = layout.select(*own, level_col, "row_start", "row_end", "parent_row")
        tagged = range_join(rows, lay, row, "row_start", "row_end", own)
    else:
        r = F.col(row)
        level = parent_row = None
        for lvl, first, last, parent in layout:
            hit = r.between(int(first), int(last))
            p = F.lit(None if parent is None else int(parent)).cast("int")
            level = F.when(hit, F.lit(int(lvl))) if level is None else level.when(hit, F.lit(int(lvl)))
            parent_row = F.when(hit, p) if parent_row is None else parent_row.when(hit, p)
        tagged = (rows.withColumn(level_col, level).withColumn("parent_row", parent_row)
                  .filter(F.col(level_col).isNotNull()))
    parents = rows.select(*report, F.col(row).alias("parent_row"), F.col(name).alias(parent_col))
    return (lookup_join(tagged, parents, report + ["parent_row"], "left")
            .select(*rows.columns, level_col, parent_col,
                    (F.col(level_col) == leaf_level).alias(leaf_col)))


def row_extent(cells: DataFrame, report, row: str = "row_idx") -> DataFrame:
    """Last non-empty column of every row (trailing empties trimmed)."""
    return cells.groupBy(*_list(report), row).agg(F.max("col_idx").alias("last_col"))


def check_anchors(cells: DataFrame, anchors: Sequence[tuple[int, int, str]], report,
                  row: str = "row_idx") -> DataFrame:
    """Every (report, anchor) whose cell text differs from the expected text.

    ``reason`` is ``missing_row`` when the report is too short to hold the
    anchor row, else ``mismatch`` (an empty cell counts as a mismatch). One
    aggregation per report computes its last row and the text at every anchor
    position (the anchor list is configuration, so this is a fixed number of
    conditional aggregates - partial aggregation, no join); the anchors are
    then unpacked into rows.
    """
    report = _list(report)
    r, c = F.col(row), F.col("col_idx")
    aggs = [F.max(row).alias("last_row")] + [
        F.max(F.when((r == int(ar)) & (c == int(ac)), F.col("value"))).alias(f"_anchor{i}")
        for i, (ar, ac, _) in enumerate(anchors)]
    per_report = cells.groupBy(*report).agg(*aggs)
    unpacked = F.array(*[F.struct(F.lit(int(ar)).alias("anchor_row"), F.lit(int(ac)).alias("anchor_col"),
                                  F.lit(t).alias("expected"), F.col(f"_anchor{i}").alias("actual"))
                         for i, (ar, ac, t) in enumerate(anchors)])
    checked = per_report.select(*report, "last_row", F.inline(unpacked))
    return (checked.filter(~F.col("actual").eqNullSafe(F.col("expected")))
            .select(*report, "anchor_row", "anchor_col", "expected", "actual",
                    F.when(F.col("last_row") < F.col("anchor_row"), F.lit("missing_row"))
                    .otherwise(F.lit("mismatch")).alias("reason")))
