import io
import zipfile

import pytest
from pyspark.sql import functions as F

from fixtures import CGD_SHEET, OCSC_SHEET, cgd_grid, make_xlsx, ocsc_grid, write
from ledgerlake.sources import archives, workbook


def _cells(spark, scratch, sheets, **kw):
    write(f"{scratch}/raw/book.xlsx", make_xlsx(sheets, **kw))
    return workbook.read_report_cells(spark, f"{scratch}/raw")


def test_decode_positions_and_types(spark, scratch):
    cells = _cells(spark, scratch, {CGD_SHEET: cgd_grid()})
    got = {(r.row_idx, r.col_idx): r for r in cells.filter(F.col("row_idx").isin(3, 5, 29)).collect()}
    assert got[(3, 0)].value == "ลำดับ\nที่"
    assert got[(5, 1)].value == "กระทรวงคมนาคม"
    assert got[(5, 21)].value == "08"          # code stays text
    assert got[(5, 0)].value == "1" and got[(5, 0)].num == 1.0
    assert got[(5, 3)].num == pytest.approx(12479.19303697)
    assert (5, 2) not in got                  # empty cell -> no row
    assert got[(29, 21)].value == " "         # stray blank code survives extraction


def test_rich_text_shared_strings(spark, scratch):
    cells = _cells(spark, scratch, {"s": [["abcdef", 1]]}, rich_text=True)
    assert cells.filter("col_idx = 0").first().value == "abcdef"


def test_sheet_filter_and_inventory_lists_empty_sheets(spark, scratch):
    write(f"{scratch}/raw/book.xlsx", make_xlsx({"a": [["x"]], "empty": [], OCSC_SHEET: ocsc_grid()}))
    files = workbook.binary_files(spark, f"{scratch}/raw")
    inv = [r.sheet for r in workbook.sheet_inventory(files).orderBy("sheet_index").collect()]
    assert inv == ["a", "empty", OCSC_SHEET]
    only = workbook.cells_from_binary(files, sheets=[OCSC_SHEET])
    assert {r.sheet for r in only.select("sheet").distinct().collect()} == {OCSC_SHEET}


def test_max_rows_stops_early(spark, scratch):
    write(f"{scratch}/raw/book.xlsx", make_xlsx({"s": [[i] for i in range(1000)]}))
    cells = workbook.read_report_cells(spark, f"{scratch}/raw", max_rows=500)
    assert cells.count() == 500 and cells.agg(F.max("row_idx")).first()[0] == 499


def test_formula_cells_counted(spark, scratch):
    cells = _cells(spark, scratch, {"s": [["=SUM(A2:A3)"], [1], [2]]})
    counts = cells.agg(F.count_if(F.col("formula").startswith("=")).alias("f"), F.count("*").alias("n")).first()
    assert (counts.f, counts.n) == (1, 3)


def _zip(members: dict) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for k, v in members.items():
            z.writestr(k, v)
    return buf.getvalue()


def test_unwrap_archives(spark, scratch):
    book = make_xlsx({"s": [["x"]]})
    write(f"{scratch}/dl/a.bin", _zip({"2026_07_10/Report.XLSX": book, "readme.txt": "x"}))
    write(f"{scratch}/dl/b.bin", book)                    # a bare workbook passes through
    write(f"{scratch}/dl/c.bin", b"not a zip at all")    # non-zip passes through
    write(f"{scratch}/dl/d.bin", _zip({"notes.txt": "no workbook"}))
    files = workbook.binary_files(spark, f"{scratch}/dl", glob="*.bin")
    out = {r.path.rsplit("/", 1)[1]: r for r in archives.unwrap_archives(files).collect()}
    assert bytes(out["a.bin"].payload) == book
    assert bytes(out["b.bin"].payload) == book
    assert bytes(out["c.bin"].payload) == b"not a zip at all"
    assert out["d.bin"].payload is None and "no .xlsx" in out["d.bin"].unwrap_error
