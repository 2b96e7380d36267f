"""Outcomes of landed files: each content once, whatever the order of arrival, and one expression for all callers."""

import datetime as dt
import io
import itertools
import zipfile

import pytest
from pyspark.sql import functions as F

from fixtures import CGD_SHEET, cgd_grid, make_xlsx, write
from ledgerlake.sources import archives, manifest, workbook
from ledgerlake.streaming import status as st
from ledgerlake.streaming.incremental import IncrementalIngest, classify_files

FILES = "source string, path string, sha256 string, report_date date, error string"


def _status(spark, rows, entries=(("S", "2026-07-03", "seed"),)):
    files = spark.createDataFrame([(s, p, h, d and dt.date.fromisoformat(d), e) for s, p, h, d, e in rows], FILES)
    known = manifest.entries_from_rows(spark, [{"source": s, "report_date": d, "sha256": h} for s, d, h in entries])
    return {(r.source, r.path): (r.status, r.reason) for r in st.landed_status(files, known).collect()}


A = ("S", "a/2026_07_10.xlsx", "x", "2026-07-10", None)
B = ("S", "c/2026_08_01.xlsx", "x", "2026-08-01", None)     # the same bytes under a later date
C = ("S", "b/2026_08_01.xlsx", "y", "2026-08-01", None)     # another report of that date


def test_same_bytes_on_two_dates_load_once_with_and_without_other_files(spark):
    alone = _status(spark, [A, B])
    assert alone == {A[:2]: ("new", None), B[:2]: ("duplicate", st.HELD)}
    for order in itertools.permutations([A, B, C]):
        assert _status(spark, order) == alone | {C[:2]: ("new", None)}


def test_second_report_of_a_date_and_its_copies_fail(spark):
    d = ("S", "d/2026_08_01.xlsx", "z", "2026-08-01", None)
    e = ("S", "e/2026_08_08.xlsx", "z", "2026-08-08", None)     # copy of the refused file
    for order in itertools.permutations([C, d, e]):
        assert _status(spark, order) == {C[:2]: ("new", None), d[:2]: ("failed", st.SECOND), e[:2]: ("failed", st.COPY_OF_SECOND)}
    assert _status(spark, [C, d, e], [("S", "2026-07-03", "seed"), ("S", "2026-08-01", "y")]) == {
        C[:2]: ("duplicate", st.HELD), d[:2]: ("nothing_new", "not newer than the known report"), e[:2]: ("new", None)}


def test_rules_in_order_and_sources_apart(spark):
    rows = [("S", "1", "seed", "2026-09-01", "no workbook"), ("S", "2", "q", None, None), ("T", "3", "q", "2026-09-01", None),
            ("S", "4", "seed", "2026-09-01", None), ("S", "5", "late", "2026-07-03", None), ("U", "6", "u", "2026-09-01", None),
            ("S", "7", "s", "2026-09-01", None), ("U", "8", "s", "2026-09-02", None), ("S", "9", None, "2026-09-03", None)]
    out = _status(spark, rows, [("S", "2026-07-03", "seed"), ("U", "2026-01-01", None)])
    assert [out[r[:2]][0] for r in rows] == ["failed", "failed", "failed", "duplicate", "nothing_new", "new", "new", "duplicate", "new"]
    assert out["S", "1"][1] == "no workbook" and out["T", "3"][1] == "no manifest entry to inherit"
    assert _status(spark, []) == {}


def test_classify_files_uses_it(spark):
    files = spark.createDataFrame([("l/2026_07_10.xlsx", b"x", None), ("l/2026_08_01.xlsx", b"x", None), ("l/notes.xlsx", b"n", None)],
                                  "path string, payload binary, unwrap_error string")
    known = manifest.entries_from_rows(spark, [{"source": "S", "report_date": "2026-07-03", "sha256": "seed"}])
    out = {r.path[2:]: (r.status, bytes(r.payload)) for r in classify_files(files, known, "S").collect()}
    assert out == {"2026_07_10.xlsx": ("new", b"x"), "2026_08_01.xlsx": ("duplicate", b"x"), "notes.xlsx": ("failed", b"n")}
    assert {r.status for r in classify_files(files, None, "S").collect()} == {"failed"}


def _zip(name, data):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("folder/readme.txt", "x")
        z.writestr(f"folder/{name}", data)
    return out.getvalue()


def test_archives_are_ingested_and_loaded(spark, scratch):
    book = make_xlsx({CGD_SHEET: cgd_grid()})
    write(f"{scratch}/landing/2026_07_10.zip", _zip("2026_07_10.xlsx", book))
    write(f"{scratch}/landing/x/2026_07_17.xlsx", book)                       # the archive's content again
    write(f"{scratch}/landing/2026_07_24.zip", _zip("data.csv", b"1"))        # no workbook inside
    ing = IncrementalIngest(spark, f"{scratch}/landing", f"{scratch}/wh", f"{scratch}/manifest", f"{scratch}/status", f"{scratch}/ck")
    ing.seed_manifest(manifest.entries_from_rows(spark, [
        {"source": "CGD", "source_url": "https://example.org", "local_path": "raw/cgd/2026_07_03.xlsx", "report_date": "2026-07-03", "sha256": "s"}]))
    out = {r.path.rsplit("/", 1)[1]: r.status for r in ing.run().collect()}
    assert out == {"2026_07_10.zip": "new", "2026_07_17.xlsx": "duplicate", "2026_07_24.zip": "failed"}
    entries = manifest.read_manifest_table(spark, f"{scratch}/manifest")
    assert {r.local_path for r in entries.collect()} == {"raw/cgd/2026_07_03.xlsx", "raw/cgd/2026_07_10.xlsx"}
    write(f"{scratch}/again/2026_07_10.zip", _zip("2026_07_10.xlsx", book))
    files = archives.report_files(spark, f"{scratch}/again")
    assert [r.path.rsplit("/", 1)[1] for r in files.select("path").collect()] == ["2026_07_10.xlsx"]
    assert workbook.cells_from_binary(files, sheets=[CGD_SHEET]).filter(F.col("row_idx") == 5).count() > 0
    with pytest.raises(Exception, match="no .xlsx member"):
        archives.report_files(spark, f"{scratch}/landing").select("content").collect()
