"""Report files -> staging -> clean long rows -> star schema.

Every step is keyed by the report ``path``, so one job handles any number of
reports: the cell table is shuffled by ``(path, row_idx)`` once for the
pivot, totals are joined per report (never a global single-partition window),
and loading is anti-join + append per table, dimensions before facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import scalars as sc
from ..functions import web
from ..operators import dedup, grid, joins, keys, quality, reshape
from .calendar_dim import daily_rows, yearly_rows
from .layouts import CGD_GROUPS, CGD_LAYOUT, CGD_MEASURES, OCSC_LAYOUT, Layout
from .warehouse import NATURAL_KEYS, Warehouse

# ---------------------------------------------------------------- validation


def structure_violations(files: DataFrame, cells: DataFrame, layout: Layout) -> DataFrame:
    """Why a report does not match its layout: ``missing_sheet`` (no cells in the
    expected sheet), ``missing_row`` (too short for an anchor), ``mismatch``, or
    ``missing_data_row`` (a data row without any text, in a report long enough
    for its anchors)."""
    sheet_cells = cells.filter(F.col("sheet") == layout.sheet)
    missing = (files.select("path").distinct().join(sheet_cells.select("path"), "path", "left_anti")
               .select("path", F.lit(None).cast("int").alias("anchor_row"), F.lit(None).cast("int").alias("anchor_col"),
                       F.lit(layout.sheet).alias("expected"), F.lit(None).cast("string").alias("actual"),
                       F.lit("missing_sheet").alias("reason")))
    anchors = (grid.check_anchors(sheet_cells, layout.anchors, "path") if layout.anchors
               else missing.limit(0))
    # Reports that lack the sheet, or are too short for it, are reported as such, not row by row.
    whole = files.select("path").distinct().join(
        missing.select("path").unionByName(anchors.filter(F.col("reason") == "missing_row").select("path")), "path", "left_anti")
    layout_cells = sheet_cells.filter(F.col("col_idx").isin(sorted(layout.columns.values())))
    empty = grid.missing_rows(whole, layout_cells, "path", layout.row_ranges).select(
        "path", F.col("row_idx").cast("int").alias("anchor_row"), F.lit(None).cast("int").alias("anchor_col"),
        F.lit("data row").alias("expected"), F.lit(None).cast("string").alias("actual"), F.lit("missing_data_row").alias("reason"))
    return missing.unionByName(anchors).unionByName(empty)


def validate_structure(files: DataFrame, cells: DataFrame, layout: Layout) -> None:
    """Fail loudly before anything is extracted or written."""
    quality.enforce(structure_violations(files, cells, layout), error=quality.StructureValidationError,
                    names=[f"layout of sheet {layout.sheet!r}"])


# ---------------------------------------------------------------- extract (text, never stripped)


def extract_cgd(cells: DataFrame, layout: Layout = CGD_LAYOUT) -> DataFrame:
    """One wide staging row per ministry row: ``path, row_idx`` + every layout field as text
    (a row without cells stays, as NULLs, and fails the cleaning)."""
    sheet = cells.filter(F.col("sheet") == layout.sheet)
    return grid.records_from_cells(sheet, layout.columns, list(layout.columns), "path", rows=layout.row_ranges)


def extract_ocsc(cells: DataFrame, layout: Layout = OCSC_LAYOUT) -> DataFrame:
    """Grand total, subtotals and leaves with level and (raw) parent name."""
    sheet = cells.filter(F.col("sheet") == layout.sheet)
    recs = grid.records_from_cells(sheet, layout.columns, list(layout.columns), "path", rows=layout.row_ranges)
    return grid.tag_sections(recs, layout.sections, "path", "category_name")


# ---------------------------------------------------------------- clean


def clean_cgd(staging: DataFrame) -> DataFrame:
    """Wide ministry rows -> 3 long rows each; ratios recomputed (stated % dropped).

    Code and name pass through untouched; measures must parse strictly.
    """
    measures = [f"{p}_{m}" for p, _, _ in CGD_GROUPS for m in CGD_MEASURES]
    wide = staging.select("path", "row_idx", "ministry_code", "ministry_name",
                          *[sc.required_number(F.col(c), "double", c).alias(c) for c in measures])
    groups = [(p, name, leaf) for p, name, leaf in CGD_GROUPS]
    long = reshape.wide_to_long(wide, ["path", "row_idx", "ministry_code", "ministry_name"], groups,
                                CGD_MEASURES, name_col="expense_type_name")
    order = F.array_position(F.array(*[F.lit(n) for _, n, _ in CGD_GROUPS]), F.col("expense_type_name"))
    return long.select(
        "path", "row_idx", order.cast("int").alias("group_pos"), "ministry_code", "ministry_name",
        "expense_type_name", "is_leaf", *CGD_MEASURES,
        sc.remaining("budget_after_transfer", "disbursed").alias("remaining"),
        sc.safe_pct("disbursed", "budget_after_transfer").alias("disbursed_pct"))


def clean_ocsc(staging: DataFrame) -> DataFrame:
    """Strip names, parse headcount strictly, leaf = level 2, share of the
    report's first grand-total row (a report without one fails)."""
    s = staging.select(
        "path", "row_idx", sc.strip("category_name").alias("category_name"),
        sc.required_number("headcount", "long", "headcount").alias("headcount"), "hierarchy_level",
        sc.blank_to_null("parent_category").alias("parent_category"),
        (F.col("hierarchy_level") == 2).alias("is_leaf"))
    totals = (s.filter(F.col("hierarchy_level") == 0).groupBy("path")
              .agg(F.min_by("headcount", "row_idx").alias("_grand")))
    out = joins.lookup_join(s, totals, "path", "left")                # one row per report
    grand = F.coalesce(F.col("_grand"), F.raise_error(F.concat(F.lit("no grand total row in "), F.col("path")))
                       .cast("long"))
    return out.withColumn("share_pct", sc.safe_pct("headcount", grand)).drop("_grand")


# ---------------------------------------------------------------- load


def _upsert_dim(wh: Warehouse, name: str, candidates: DataFrame) -> DataFrame:
    """Insert absent natural keys with fresh surrogate keys; return the dimension."""
    from .warehouse import SURROGATE_KEYS
    nk, key = NATURAL_KEYS[name], SURROGATE_KEYS[name]
    existing = wh.read(name)
    new = keys.absent_rows(existing, candidates, nk).cache()
    try:
        if not new.isEmpty():
            keyed = keys.assign_keys(new, nk, key, existing=existing)
            wh.append(name, new.join(keyed, nk))
    finally:
        new.unpersist()
    return wh.read(name)


def _load_sources(wh: Warehouse, reports: DataFrame, agency: str) -> DataFrame:
    cands = reports.select(F.lit(agency).alias("agency"), "source_url",
                           web.base_name("local_path").alias("file_name"),
                           F.col("sha256").alias("file_hash"), F.current_timestamp().alias("ingested_at"),
                           "ordinal")
    cands = dedup.dedup(cands, "file_hash", "ordinal", keep="first").drop("ordinal")
    return _upsert_dim(wh, "dim_source", cands)


def _report_keys(reports: DataFrame, dim_source: DataFrame, dim_date: DataFrame, date_nk) -> DataFrame:
    """``path -> (date_key, source_id)`` for every report."""
    r = reports.select("path", F.col("sha256").alias("file_hash"), date_nk.alias("date_natural_key"))
    r = keys.resolve_key(r, dim_source.select("file_hash", "source_id"), "file_hash", "source_id")
    r = keys.resolve_key(r, dim_date.select("date_natural_key", "date_key"), "date_natural_key", "date_key")
    return r.select("path", "date_key", "source_id")


def _append_facts(wh: Warehouse, name: str, facts: DataFrame, ordinal) -> int:
    nk = NATURAL_KEYS[name]
    batch = dedup.dedup(facts, nk, ordinal, keep="first")
    touched = batch.select("date_key").distinct()
    # Only the partitions of the dates being loaded are read back.
    existing = joins.lookup_join(wh.read(name), touched, "date_key", "left_semi")
    return wh.append(name, batch.join(existing.select(*nk), nk, "left_anti"))


def load_cgd(wh: Warehouse, clean: DataFrame, reports: DataFrame) -> int:
    """``reports(path, source_url, local_path, report_date, sha256, ordinal)``; returns facts written."""
    src = _load_sources(wh, reports, "CGD")
    dates = _upsert_dim(wh, "dim_date", daily_rows(reports.select(F.to_date("report_date").alias("report_date"))))
    # Inside one batch the last row's attributes win; across batches the first load wins.
    et = dedup.dedup(clean.select("expense_type_name", "is_leaf", "path", "row_idx", "group_pos"),
                     "expense_type_name", ["path", "row_idx", "group_pos"], keep="last")
    et_dim = _upsert_dim(wh, "dim_expense_type", et.select("expense_type_name", "is_leaf"))
    mins = dedup.dedup(clean.select("ministry_code", "ministry_name", "path", "row_idx"),
                       "ministry_code", ["path", "row_idx"], keep="last")
    min_dim = _upsert_dim(wh, "dim_ministry", mins.select(
        "ministry_code", F.col("ministry_name").alias("ministry_name_th"),
        F.col("ministry_name").alias("source_name_raw")))
    rk = _report_keys(reports, src, dates, cal.date_natural_key(F.to_date("report_date")))
    f = joins.lookup_join(clean, rk, "path")                           # one row per report
    f = keys.resolve_key(f, min_dim.select("ministry_code", "ministry_key"), "ministry_code", "ministry_key")
    f = keys.resolve_key(f, et_dim.select("expense_type_name", "expense_type_key"), "expense_type_name",
                         "expense_type_key")
    return _append_facts(wh, "fact_disbursement", f, ["path", "row_idx", "group_pos"])


def load_ocsc(wh: Warehouse, clean: DataFrame, reports: DataFrame) -> int:
    """``reports(path, source_url, local_path, fiscal_year_be, sha256, ordinal)``; returns facts written."""
    src = _load_sources(wh, reports, "OCSC")
    dates = _upsert_dim(wh, "dim_date", yearly_rows(reports.select("fiscal_year_be")))
    cats = dedup.dedup(clean.select("category_name", "path", "row_idx"), "category_name", ["path", "row_idx"],
                       keep="first")
    cat_dim = _upsert_dim(wh, "dim_personnel_category", cats.select("category_name"))
    rk = _report_keys(reports, src, dates, cal.fiscal_year_natural_key(F.col("fiscal_year_be")))
    f = joins.lookup_join(clean, rk, "path")                           # one row per report
    cd = cat_dim.select("category_name", "personnel_category_key")
    f = keys.resolve_key(f, cd, "category_name", "personnel_category_key")
    f = keys.resolve_optional_key(f, cat_dim, "parent_category", "category_name", "personnel_category_key",
                                  "parent_category_key")
    f = f.withColumn("hierarchy_level", F.col("hierarchy_level").cast("tinyint"))
    return _append_facts(wh, "fact_workforce_summary", f, ["path", "row_idx"])


def attach_reports(files: DataFrame, entries: DataFrame, source: str) -> DataFrame:
    """Match landed files to their manifest entries by source and file name."""
    e = entries.filter(F.col("source") == source).withColumn("_fname", web.base_name("local_path"))
    f = files.select("path", web.base_name("path").alias("_fname"))
    return f.join(e, "_fname").drop("_fname")


def unmatched_files(files: DataFrame, entries: DataFrame, source: str) -> DataFrame:
    """Landed files without a manifest entry (they would have no date or lineage)."""
    return files.select("path").join(attach_reports(files, entries, source).select("path"), "path", "left_anti")


def run_reports(wh: Warehouse, cgd_files: DataFrame | None, ocsc_files: DataFrame | None,
                entries: DataFrame, cells_of) -> dict[str, int]:
    """Validate, extract, clean and load both sources. ``cells_of(files, sheet)``
    decodes the given files (see ``sources.workbook``). Returns facts written.
    Every file must have a manifest entry; otherwise nothing is written."""
    checks = [(f"{src} file without manifest entry", unmatched_files(f, entries, src))
              for src, f in (("CGD", cgd_files), ("OCSC", ocsc_files)) if f is not None]
    quality.enforce(*[c for _, c in checks], names=[n for n, _ in checks])
    wh.ensure_schema()
    out = {"fact_disbursement": 0, "fact_workforce_summary": 0}
    if cgd_files is not None:
        # Cached: validation and extraction both read the decoded cells.
        cells = cells_of(cgd_files, CGD_LAYOUT.sheet).cache()
        try:
            validate_structure(cgd_files, cells, CGD_LAYOUT)
            clean = clean_cgd(extract_cgd(cells))
            out["fact_disbursement"] = load_cgd(wh, clean, attach_reports(cgd_files, entries, "CGD"))
        finally:
            cells.unpersist()
    if ocsc_files is not None:
        cells = cells_of(ocsc_files, OCSC_LAYOUT.sheet).cache()
        try:
            validate_structure(ocsc_files, cells, OCSC_LAYOUT)
            clean = clean_ocsc(extract_ocsc(cells))
            out["fact_workforce_summary"] = load_ocsc(wh, clean, attach_reports(ocsc_files, entries, "OCSC"))
        finally:
            cells.unpersist()
    return out
