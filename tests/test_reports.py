import os

import pytest
from pyspark.sql import functions as F

from fixtures import CGD_SHEET, OCSC_SHEET, cgd_grid, make_xlsx, ocsc_grid, sha256, write
from ledgerlake.operators.quality import StructureValidationError
from ledgerlake.plans import reports
from ledgerlake.plans.layouts import CGD_LAYOUT, OCSC_LAYOUT
from ledgerlake.plans.warehouse import Warehouse
from ledgerlake.sources import manifest, workbook

CGD_URL = "https://example.org/cgd/listing.html"
OCSC_URL = "https://example.org/ocsc/reports/"


def _cells_of(files, sheet):
    return workbook.cells_from_binary(files, sheets=[sheet])


def _land(scratch, cgd_dates=("2026_07_03",), cgd_grid_rows=None):
    out = {}
    for d in cgd_dates:
        data = make_xlsx({"1.สรุป": [["x"]], CGD_SHEET: cgd_grid_rows or cgd_grid()})
        write(f"{scratch}/raw/cgd/{d}.xlsx", data)
        out[d] = sha256(data)
    ocsc = make_xlsx({OCSC_SHEET: ocsc_grid()})
    write(f"{scratch}/raw/ocsc/thaigovmanpower2567_4.xlsx", ocsc)
    out["ocsc"] = sha256(ocsc)
    return out


def _entries(spark, hashes, cgd_dates=("2026_07_03",)):
    rows = [{"source": "CGD", "source_url": CGD_URL, "local_path": f"raw/cgd/{d}.xlsx",
             "report_date": d.replace("_", "-"), "sha256": f"{hashes[d]}-{d}"} for d in cgd_dates]
    rows.append({"source": "OCSC", "source_url": OCSC_URL, "local_path": "raw/ocsc/thaigovmanpower2567_4.xlsx",
                 "fiscal_year_be": 2567, "sha256": hashes["ocsc"]})
    return manifest.entries_from_rows(spark, rows)


def _files(spark, scratch, sub):
    return workbook.binary_files(spark, f"{scratch}/raw/{sub}")


def _staging(spark, scratch):
    _land(scratch)
    cgd = _cells_of(_files(spark, scratch, "cgd"), CGD_SHEET)
    ocsc = _cells_of(_files(spark, scratch, "ocsc"), OCSC_SHEET)
    return reports.extract_cgd(cgd), reports.extract_ocsc(ocsc)


def test_extract_counts_and_raw_text(spark, scratch):
    cgd, ocsc = _staging(spark, scratch)
    assert cgd.count() == 24 and ocsc.count() == 25
    assert cgd.filter(F.col("ministry_name") == "รวม").count() == 0      # total row excluded
    first = cgd.filter("row_idx = 5").first()
    assert (first.ministry_code, first.ministry_name, first.seq_no) == ("08", "กระทรวงคมนาคม", "1")
    levels = sorted(r[0] for r in ocsc.select("hierarchy_level").distinct().collect())
    assert levels == [0, 1, 2]
    # extraction never strips: the trailing space survives until cleaning
    assert ocsc.filter(F.col("category_name") == "องค์กรอิสระตามรัฐธรรมนูญ ").count() == 1
    parents = {r.category_name: r.parent_category for r in ocsc.collect()}
    assert parents["รวมทั้งหมด"] is None
    assert parents["ข้าราชการ"] == "รวมทั้งหมด" and parents["ตำรวจ"] == "ข้าราชการ"
    assert parents["ลูกจ้างประจำ"] == "กำลังคนประเภทอื่น"


def test_clean_cgd(spark, scratch):
    cgd, _ = _staging(spark, scratch)
    clean = reports.clean_cgd(cgd).cache()
    assert clean.count() == 72
    fd = clean.groupBy("expense_type_name").agg(F.countDistinct("is_leaf").alias("n")).collect()
    assert all(r.n == 1 for r in fd) and len(fd) == 3
    assert clean.filter("is_leaf").count() == 48
    zero = {r.expense_type_name: r for r in clean.filter(F.col("ministry_code") == "99").collect()}
    assert zero["รายจ่ายประจำ"].disbursed_pct is None
    assert zero["รายจ่ายลงทุน"].disbursed_pct == pytest.approx(50.0)
    assert zero["รวม"].disbursed_pct == pytest.approx(50.0)
    r5 = clean.filter("row_idx = 5 AND expense_type_name = 'รวม'").first()
    assert r5.disbursed_pct == pytest.approx(53.40695863198572, rel=1e-9)
    assert r5.remaining == pytest.approx(199955.9235 - 106790.37734585)


def test_clean_ocsc(spark, scratch):
    _, ocsc = _staging(spark, scratch)
    clean = reports.clean_ocsc(ocsc).cache()
    names = [r.category_name for r in clean.collect()]
    assert all(n == n.strip() for n in names) and "องค์กรอิสระตามรัฐธรรมนูญ" in names
    assert clean.filter("is_leaf").count() == 22
    assert clean.filter("is_leaf").agg(F.sum("headcount")).first()[0] == 3004485
    sub = clean.filter("hierarchy_level = 1").agg(F.sum("headcount")).first()[0]
    assert sub == 3004485
    share = clean.filter(F.col("category_name") == "ข้าราชการ").first().share_pct
    assert share == pytest.approx(58.466126474254324, rel=1e-12)
    assert clean.filter("hierarchy_level = 0").first().parent_category is None


def _load(spark, scratch, wh_root, cgd_dates=("2026_07_03",)):
    hashes = _land(scratch, cgd_dates)
    wh = Warehouse(spark, wh_root)
    entries = _entries(spark, hashes, cgd_dates)
    written = reports.run_reports(wh, _files(spark, scratch, "cgd"), _files(spark, scratch, "ocsc"),
                                  entries, _cells_of)
    return wh, written


def _counts(wh):
    return {r.table_name: r.n for r in wh.row_counts().collect()}


def test_load_counts_and_idempotent_rerun(spark, scratch):
    wh, written = _load(spark, scratch, f"{scratch}/wh")
    expected = {"dim_date": 2, "dim_ministry": 24, "dim_expense_type": 3, "dim_personnel_category": 25,
                "dim_source": 2, "fact_disbursement": 72, "fact_workforce_summary": 25}
    assert _counts(wh) == expected
    assert written == {"fact_disbursement": 72, "fact_workforce_summary": 25}
    wh2, written2 = _load(spark, scratch, f"{scratch}/wh")            # replay: nothing new
    assert written2 == {"fact_disbursement": 0, "fact_workforce_summary": 0}
    assert _counts(wh2) == expected
    for name, v in wh2.violations().items():
        assert v.isEmpty(), name


def test_second_report_accumulates_lineage(spark, scratch):
    wh, _ = _load(spark, scratch, f"{scratch}/wh", cgd_dates=("2026_07_03",))
    first_sources = {r.file_hash: r.source_id for r in wh.read("dim_source").collect()}
    wh, written = _load(spark, scratch, f"{scratch}/wh", cgd_dates=("2026_07_03", "2026_07_10"))
    assert written["fact_disbursement"] == 72
    c = _counts(wh)
    assert c["dim_source"] == 3 and c["dim_date"] == 3 and c["fact_disbursement"] == 144
    after = {r.file_hash: r.source_id for r in wh.read("dim_source").collect()}
    assert all(after[h] == k for h, k in first_sources.items())          # old rows untouched
    keys = [r.source_id for r in wh.read("dim_source").collect()]
    assert len(set(keys)) == 3


def test_fiscal_calendar_rows(spark, scratch):
    wh, _ = _load(spark, scratch, f"{scratch}/wh")
    d = {r.date_natural_key: r for r in wh.read("dim_date").collect()}
    assert d["2026-07-03"].fiscal_year_be == 2569 and d["2026-07-03"].quarter == 4
    assert d["2026-07-03"].is_month_end is False and d["2026-07-03"].month == 7
    assert d["FY2567"].fiscal_year_ce == 2024 and d["FY2567"].report_date is None


def test_parent_keys_and_leaf_sum(spark, scratch):
    wh, _ = _load(spark, scratch, f"{scratch}/wh")
    fw = wh.read("fact_workforce_summary")
    cat = wh.read("dim_personnel_category")
    nulls = fw.filter(F.col("parent_category_key").isNull()).collect()
    assert len(nulls) == 1 and nulls[0].hierarchy_level == 0
    naive = fw.agg(F.sum("headcount")).first()[0]
    leaf = fw.filter("is_leaf").agg(F.sum("headcount")).first()[0]
    assert leaf == 3004485 and naive == 3 * 3004485
    police = fw.join(cat, "personnel_category_key").filter(F.col("category_name") == "ตำรวจ").first()
    parent = cat.filter(F.col("personnel_category_key") == police.parent_category_key).first()
    assert parent.category_name == "ข้าราชการ"


def _mangled(kind):
    g = cgd_grid()
    if kind == "anchor_text":
        g[3] = list(g[3]); g[3][3] = "อื่นๆ"
    elif kind == "short_header":
        g[3] = g[3][:10]
    elif kind == "total_label":
        g[29] = list(g[29]); g[29][0] = "ผลรวม"
    elif kind == "truncated":
        g = g[:5]
    return g


@pytest.mark.parametrize("kind", ["wrong_sheet", "anchor_text", "short_header", "total_label", "truncated"])
def test_structure_validation_fails_loud_and_writes_nothing(spark, scratch, kind):
    sheets = {"other": cgd_grid()} if kind == "wrong_sheet" else {CGD_SHEET: _mangled(kind)}
    data = make_xlsx(sheets)
    write(f"{scratch}/raw/cgd/2026_07_03.xlsx", data)
    files = _files(spark, scratch, "cgd")
    cells = _cells_of(files, CGD_SHEET)
    with pytest.raises(StructureValidationError):
        reports.validate_structure(files, cells, CGD_LAYOUT)
    wh = Warehouse(spark, f"{scratch}/wh")
    entries = manifest.entries_from_rows(spark, [{"source": "CGD", "local_path": "raw/cgd/2026_07_03.xlsx",
                                                  "report_date": "2026-07-03", "sha256": sha256(data)}])
    with pytest.raises(StructureValidationError):
        reports.run_reports(wh, files, None, entries, _cells_of)
    assert wh.read("fact_disbursement").count() == 0 and wh.read("dim_ministry").count() == 0


@pytest.mark.parametrize("sheet, row, blank", [(CGD_SHEET, 5, None), (CGD_SHEET, 28, "  "), (OCSC_SHEET, 3, "  "), (OCSC_SHEET, 12, None)])
def test_a_data_row_without_cells_fails_and_writes_nothing(spark, scratch, sheet, row, blank):
    hashes = _land(scratch)
    grid_rows, sub, name, layout = ((cgd_grid(), "cgd", "2026_07_03", CGD_LAYOUT) if sheet == CGD_SHEET
                                    else (ocsc_grid(), "ocsc", "thaigovmanpower2567_4", OCSC_LAYOUT))
    grid_rows[row] = [blank] * len(grid_rows[row])
    write(f"{scratch}/raw/{sub}/{name}.xlsx", make_xlsx({sheet: grid_rows}))
    files = _files(spark, scratch, sub)
    cells = _cells_of(files, sheet)
    found = reports.structure_violations(files, cells, layout).collect()
    assert [(r.anchor_row, r.reason) for r in found] == [(row, "missing_data_row")]
    dense = reports.extract_cgd(cells) if sheet == CGD_SHEET else reports.extract_ocsc(cells)
    assert dense.count() == (24 if sheet == CGD_SHEET else 25)          # the row is there, empty
    wh = Warehouse(spark, f"{scratch}/wh")
    both = {"cgd": None, "ocsc": None} | {sub: files}
    with pytest.raises(StructureValidationError, match="missing_data_row"):
        reports.run_reports(wh, both["cgd"], both["ocsc"], _entries(spark, hashes), _cells_of)
    assert all(n == 0 for n in _counts(wh).values())


def test_violation_reasons(spark, scratch):
    write(f"{scratch}/raw/cgd/2026_07_03.xlsx", make_xlsx({CGD_SHEET: _mangled("truncated")}))
    files = _files(spark, scratch, "cgd")
    v = reports.structure_violations(files, _cells_of(files, CGD_SHEET), CGD_LAYOUT).collect()
    assert [(r.anchor_row, r.reason) for r in v] == [(29, "missing_row")]
    assert OCSC_LAYOUT.anchors == ()


def test_missing_measure_fails_the_job(spark, scratch):
    g = cgd_grid()
    g[6] = list(g[6]); g[6][7] = None                     # an empty 'disbursed' cell
    write(f"{scratch}/raw/cgd/2026_07_03.xlsx", make_xlsx({CGD_SHEET: g}))
    staging = reports.extract_cgd(_cells_of(_files(spark, scratch, "cgd"), CGD_SHEET))
    with pytest.raises(Exception, match="missing recurring_disbursed"):
        reports.clean_cgd(staging).collect()


def test_write_time_constraints(spark, scratch):
    from ledgerlake.operators.quality import ConstraintViolation
    wh = Warehouse(spark, f"{scratch}/wh")
    bad = spark.createDataFrame([(1, "FY2567", None, 2567, 2023, None, None, None)],
                                "date_key long, date_natural_key string, report_date date, fiscal_year_be int, "
                                "fiscal_year_ce int, month int, quarter int, is_month_end boolean")
    with pytest.raises(ConstraintViolation, match="check_era"):
        wh.append("dim_date", bad)
    assert wh.read("dim_date").count() == 0


def test_unique_and_foreign_keys_are_rejected(spark, scratch):
    from ledgerlake.operators.quality import ConstraintViolation
    wh, _ = _load(spark, scratch, f"{scratch}/wh")
    dup = wh.read("dim_ministry").limit(1).withColumn("ministry_key", F.lit(999).cast("long"))
    with pytest.raises(ConstraintViolation, match="unique"):
        wh.append("dim_ministry", dup)                         # same ministry_code again
    fact = wh.read("fact_disbursement").limit(1).withColumn("ministry_key", F.lit(424242).cast("long")) \
        .withColumn("date_key", F.lit(777).cast("long"))
    with pytest.raises(ConstraintViolation, match="fk"):
        wh.append("fact_disbursement", fact)                   # unknown ministry and date
    assert wh.read("fact_disbursement").count() == 72 and wh.read("dim_ministry").count() == 24


def test_write_pass_rules_leave_no_row_and_no_staged_file(spark, scratch):
    from ledgerlake.operators.quality import ConstraintViolation
    wh, _ = _load(spark, scratch, f"{scratch}/wh")
    new_date = wh.read("dim_date").limit(1).select(
        F.lit(50).cast("long").alias("date_key"), F.lit("2030-01-05").alias("date_natural_key"), F.to_date(F.lit("2030-01-05")).alias("report_date"),
        F.lit(2573).alias("fiscal_year_be"), F.lit(2030).alias("fiscal_year_ce"), F.lit(1).alias("month"), F.lit(2).alias("quarter"),
        F.lit(False).alias("is_month_end"))
    assert wh.append("dim_date", new_date) == 1
    facts = wh.read("fact_disbursement").withColumn("date_key", F.lit(50).cast("long"))
    staff = wh.read("fact_workforce_summary").withColumn("date_key", F.lit(50).cast("long"))
    total = F.col("expense_type_key") == wh.read("dim_expense_type").filter("NOT is_leaf").first().expense_type_key
    one = (F.col("ministry_key") == facts.agg(F.min("ministry_key")).first()[0]) & total
    for table, rows, rule in (
            ("fact_disbursement", facts.withColumn("disbursed", F.when(one, F.col("budget_after_transfer") + 1).otherwise(F.col("disbursed"))), "disbursed_le_budget"),
            ("fact_disbursement", facts.withColumn("allocated", F.when(one, F.col("allocated") + 1).otherwise(F.col("allocated"))), "parts_equal_total"),
            ("fact_disbursement", facts.unionByName(facts.filter(one)), "unique"),
            ("fact_workforce_summary", staff.withColumn("headcount", F.when(F.col("hierarchy_level") == 1, F.col("headcount") + 1).otherwise(F.col("headcount"))),
             "parts_equal_total"),
            ("fact_workforce_summary", staff.withColumn("headcount", -F.col("headcount")), "headcount_nonneg"),
            ("fact_workforce_summary", staff.withColumn("parent_category_key", F.lit(None).cast("long")), "parent_only_for_total")):
        with pytest.raises(ConstraintViolation, match=rule):
            wh.append(table, rows)
    assert wh.read("fact_disbursement").count() == 72 and wh.read("fact_workforce_summary").count() == 25
    assert wh.append("fact_disbursement", facts) == 72 and wh.append("fact_workforce_summary", staff) == 25
    assert wh.append("fact_disbursement", facts.limit(0)) == 0
    with pytest.raises(ConstraintViolation, match="against stored rows"):
        wh.append("fact_disbursement", facts.filter(one))
    assert os.listdir(f"{scratch}/wh/_staging") == []
    assert all(v.isEmpty() for v in wh.violations().values())


def test_file_without_manifest_entry_fails(spark, scratch):
    from ledgerlake.operators.quality import ConstraintViolation
    hashes = _land(scratch)
    wh = Warehouse(spark, f"{scratch}/wh")
    only_ocsc = _entries(spark, hashes).filter("source = 'OCSC'")
    with pytest.raises(ConstraintViolation, match="without manifest entry"):
        reports.run_reports(wh, _files(spark, scratch, "cgd"), _files(spark, scratch, "ocsc"), only_ocsc, _cells_of)
    assert wh.read("fact_workforce_summary").count() == 0
