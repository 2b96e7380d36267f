import os

from pyspark.sql import functions as F

from fixtures import CGD_SHEET, cgd_grid, make_xlsx, write
from ledgerlake.plans.warehouse import Warehouse
from ledgerlake.sources import manifest
from ledgerlake.streaming.incremental import IncrementalIngest, status_by_source


def _book(tag: str) -> bytes:
    g = cgd_grid()
    g[1] = [f"ณ วันที่ {tag}"]          # different bytes per report
    return make_xlsx({CGD_SHEET: g})


def _ingest(spark, scratch, ckpt="ckpt"):
    os.makedirs(f"{scratch}/landing", exist_ok=True)
    return IncrementalIngest(spark, f"{scratch}/landing", f"{scratch}/wh", f"{scratch}/manifest",
                             f"{scratch}/status", f"{scratch}/{ckpt}", raw_path=f"{scratch}/raw")


def _statuses(df):
    return {r.path.rsplit("/", 1)[1]: r.status for r in df.collect()}


def test_stream_ingest_new_duplicate_late_and_replay(spark, scratch):
    ing = _ingest(spark, scratch)
    ing.seed_manifest(manifest.entries_from_rows(spark, [
        {"source": "CGD", "source_name_th": "CGD", "source_url": "https://example.org/list",
         "local_path": "raw/cgd/2026_07_03.xlsx", "report_date": "2026-07-03", "sha256": "seed-hash"}]))
    assert ing.run().count() == 0                                   # nothing landed: no batch

    write(f"{scratch}/landing/2026_07_10.xlsx", _book("10"))
    s1 = _statuses(ing.run())
    assert s1 == {"2026_07_10.xlsx": "new"}
    wh = Warehouse(spark, f"{scratch}/wh")
    assert wh.read("fact_disbursement").count() == 72

    write(f"{scratch}/landing/2026_07_17.xlsx", _book("10"))        # same bytes, new date
    write(f"{scratch}/landing/2026_07_01.xlsx", _book("01"))        # older than the known mark
    write(f"{scratch}/landing/2026_07_24.xlsx", _book("24"))        # genuinely new
    write(f"{scratch}/landing/notes.xlsx", b"not a workbook")       # no date -> failed
    s2 = _statuses(ing.run())
    assert s2 == {"2026_07_17.xlsx": "duplicate", "2026_07_01.xlsx": "nothing_new",
                  "2026_07_24.xlsx": "new", "notes.xlsx": "failed"}
    assert wh.read("fact_disbursement").count() == 144
    entries = manifest.read_manifest_table(spark, f"{scratch}/manifest")
    assert entries.count() == 3
    assert entries.filter(F.col("report_date") == "2026-07-24").first().local_path == "raw/cgd/2026_07_24.xlsx"

    write(f"{scratch}/landing/report_2026_07_31.xlsx", _book("31"))   # date inside a longer name
    assert _statuses(ing.run()) == {"report_2026_07_31.xlsx": "new"}
    assert wh.read("fact_disbursement").count() == 216

    # Replay the whole landing zone with a fresh checkpoint: nothing is loaded twice.
    again = _statuses(_ingest(spark, scratch, ckpt="ckpt2").run())
    assert again["2026_07_10.xlsx"] == "duplicate" and again["2026_07_24.xlsx"] == "duplicate"
    assert wh.read("fact_disbursement").count() == 216
    assert manifest.read_manifest_table(spark, f"{scratch}/manifest").count() == 4
    raw = spark.read.parquet(f"{scratch}/raw")
    assert raw.count() == 3 and raw.select("source").distinct().first().source == "CGD"
    per_source = status_by_source(spark.read.parquet(f"{scratch}/status")).collect()
    assert {r.status for r in per_source} <= {"new", "failed", "duplicate", "nothing_new"}


def test_late_copy_does_not_hide_a_new_report_and_same_dates_never_mix(spark, scratch):
    ing = _ingest(spark, scratch)
    ing.seed_manifest(manifest.entries_from_rows(spark, [
        {"source": "CGD", "source_name_th": "CGD", "source_url": "https://example.org/list",
         "local_path": "raw/cgd/2026_07_03.xlsx", "report_date": "2026-07-03", "sha256": "seed-hash"}]))
    os.makedirs(f"{scratch}/landing/b")
    write(f"{scratch}/landing/2026_07_01.xlsx", _book("10"))        # late, same bytes as the new report
    write(f"{scratch}/landing/2026_07_10.xlsx", _book("10"))
    write(f"{scratch}/landing/2026_07_17.xlsx", _book("17"))
    write(f"{scratch}/landing/b/2026_07_17.xlsx", _book("17 again"))  # another report of the same date
    rows = {r.path.split("/landing/")[1]: (r.status, r.reason) for r in ing.run().collect()}
    assert rows["2026_07_01.xlsx"][0] == "nothing_new" and rows["2026_07_10.xlsx"][0] == "new"
    assert rows["2026_07_17.xlsx"][0] == "new"
    assert rows["b/2026_07_17.xlsx"] == ("failed", "another landed file has this report date")
    assert Warehouse(spark, f"{scratch}/wh").read("fact_disbursement").count() == 144
    assert manifest.read_manifest_table(spark, f"{scratch}/manifest").count() == 3
