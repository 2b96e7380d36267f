import datetime as dt
import hashlib
import json

from pyspark.sql import functions as F

from ledgerlake.operators import keys
from ledgerlake.sources import manifest, staging

DOC = {"files": [
    {"source": "TIDE", "source_name_th": "Harbour office", "source_url": "https://example.org/tide",
     "local_path": "raw/tide/2031_02_11.xlsx", "report_date": "2031-02-11", "sha256": "a1",
     "downloaded_at": "2031-02-14T08:30:00+00:00", "downloaded_by": "clerk"},
    {"source": "CREW", "source_name_th": "Crew register", "source_url": "https://example.org/crew",
     "local_path": "raw/crew/crew_list_2570.xlsx", "fiscal_year_be": 2570, "sha256": "b7",
     "downloaded_at": "2031-01-05T10:00:00+00:00", "downloaded_by": "clerk"},
    {"source": "TIDE", "source_name_th": "Harbour office", "source_url": "https://example.org/tide",
     "local_path": "raw/tide/2031_05_02.xlsx", "report_date": "2031-05-02", "sha256": "c3",
     "downloaded_at": "2031-05-03T19:12:44+00:00", "downloaded_by": "auto"},
]}


def _doc(spark, scratch, doc):
    p = f"{scratch}/manifest.json"
    with open(p, "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)
    return manifest.read_manifest_json(spark, p)


def test_read_document_and_latest_per_source(spark, scratch):
    e = _doc(spark, scratch, DOC)
    assert [r.ordinal for r in e.orderBy("ordinal").collect()] == [0, 1, 2]
    latest = {r.source: r for r in manifest.latest_per_source(e).collect()}
    assert latest["TIDE"].report_date == "2031-05-02" and latest["CREW"].fiscal_year_be == 2570


def test_known_date_is_max_not_last(spark, scratch):
    files = [DOC["files"][2], DOC["files"][1], DOC["files"][0]]          # out of date order
    known = {r.source: r.hwm for r in manifest.known_dates(_doc(spark, scratch, {"files": files})).collect()}
    assert known["TIDE"] == dt.date(2031, 5, 2)
    only_crew = manifest.known_dates(_doc(spark, scratch, {"files": [DOC["files"][1]]}))
    assert only_crew.filter(F.col("source") == "TIDE").count() == 0     # no TIDE mark -> NULL after a join
    assert manifest.latest_per_source(_doc(spark, scratch, {"files": []})).count() == 0


def test_build_entries_inherits_template(spark, scratch):
    e = _doc(spark, scratch, DOC)
    sha = hashlib.sha256(b"new report bytes").hexdigest()
    chosen = spark.createDataFrame([("TIDE", dt.date(2031, 6, 1), sha), ("TIDE", dt.date(2031, 6, 8), "d4"), ("XYZ", dt.date(2031, 6, 1), "e5")],
                                   "source string, report_date date, sha256 string")
    out = manifest.build_entries(chosen, manifest.latest_per_source(e)).orderBy("report_date").collect()
    assert len(out) == 2                                                  # no template for XYZ, one entry a report
    r = out[0]
    assert (r.local_path, r.report_date, r.source_url) == ("raw/tide/2031_06_01.xlsx", "2031-06-01", "https://example.org/tide")
    assert r.sha256 == sha and r.downloaded_by == "auto"


def test_reports_of_one_source_are_dealt_to_many_tasks(spark, scratch):
    e = _doc(spark, scratch, DOC)
    chosen = spark.range(4000).select(F.lit("TIDE").alias("source"), F.to_date(F.lit("2031-06-01")).alias("report_date"), F.col("id").cast("string").alias("sha256"))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        out = manifest.build_entries(chosen, manifest.latest_per_source(e))
        held = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == 4000 and max(held) < 2000                     # a plain join puts all in one
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hash_known_and_append(spark, scratch):
    e = _doc(spark, scratch, DOC)
    incoming = spark.createDataFrame([("c3",), ("h9",)], "sha256 string")
    flags = {r.sha256: r.is_known for r in keys.in_known(incoming, e, "sha256").collect()}
    assert flags == {"c3": True, "h9": False}
    manifest.append_entries(e, f"{scratch}/mtable")
    manifest.append_entries(e.filter("ordinal = 2"), f"{scratch}/mtable")
    assert manifest.read_manifest_table(spark, f"{scratch}/mtable").count() == 4


def test_staging_round_trip_keeps_text_codes(spark, scratch):
    df = spark.createDataFrame([("08", "กระทรวงคมนาคม", None), ("28", "ศาล", "")], "code string, name string, x string")
    staging.write_staging(df, f"{scratch}/stg")
    back = {r.code: r for r in staging.read_staging(spark, f"{scratch}/stg").collect()}
    assert back["08"].x is None and back["28"].x == ""                  # NULL and '' stay distinct
    with open(f"{scratch}/s.csv", "w", encoding="utf-8") as f:
        f.write("code,name\n08,a\n28,b\n")
    csv = staging.read_text_csv(spark, f"{scratch}/s.csv", ["code", "name"])
    assert [r.code for r in csv.collect()] == ["08", "28"]
