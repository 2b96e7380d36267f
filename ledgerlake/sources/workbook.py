"""Workbook (.xlsx) scan: raw files -> the distributed cell table.

``spark.read.format("binaryFile")`` lists and reads the files (one file per
task; files are the unit of parallelism), and a ``mapInPandas`` function
decodes each workbook with the standard library (an .xlsx is a zip of XML
parts) and streams out one row per non-empty cell. Only the requested sheets
are decoded; ``max_rows`` stops reading a sheet early.
"""

from __future__ import annotations

import io
import posixpath
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NS_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
NS_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
NS_PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"

CELL_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("sheet", T.StringType(), False),
    T.StructField("row_idx", T.IntegerType(), False),
    T.StructField("col_idx", T.IntegerType(), False),
    T.StructField("value", T.StringType(), True),
    T.StructField("num", T.DoubleType(), True),
    T.StructField("formula", T.StringType(), True),
])

SHEET_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("sheet_index", T.IntegerType(), False),
    T.StructField("sheet", T.StringType(), False),
])

_REF = re.compile(r"([A-Z]+)([0-9]+)")
_BATCH = 50_000


def _q(tag: str) -> str:
    return f"{{{NS_MAIN}}}{tag}"


def column_index(letters: str) -> int:
    """``'A'`` -> 0, ``'Z'`` -> 25, ``'AA'`` -> 26."""
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _sheet_parts(zf: zipfile.ZipFile) -> list[tuple[str, str]]:
    """``[(sheet name, part path)]`` in workbook order."""
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    rels = {}
    if "xl/_rels/workbook.xml.rels" in zf.namelist():
        for rel in ET.fromstring(zf.read("xl/_rels/workbook.xml.rels")).iter(f"{{{NS_PKG_REL}}}Relationship"):
            target = rel.get("Target", "")
            target = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))
            rels[rel.get("Id")] = target
    out = []
    for i, sh in enumerate(wb.iter(_q("sheet"))):
        rid = sh.get(f"{{{NS_REL}}}id")
        out.append((sh.get("name"), rels.get(rid, f"xl/worksheets/sheet{i + 1}.xml")))
    return out


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in zf.namelist():
        return []
    out = []
    for si in ET.fromstring(zf.read("xl/sharedStrings.xml")).iter(_q("si")):
        # Plain <t> or rich-text runs <r><t>; phonetic hints (<rPh>) are not text.
        parts = [t.text or "" for r in si if r.tag in (_q("t"), _q("r"))
                 for t in ([r] if r.tag == _q("t") else r.iter(_q("t")))]
        out.append("".join(parts))
    return out


def _cell_value(c: ET.Element, shared: list[str]) -> tuple[str | None, float | None, str | None]:
    t = c.get("t", "n")
    f = c.find(_q("f"))
    formula = ("=" + f.text) if f is not None and f.text else None
    v = c.find(_q("v"))
    raw = v.text if v is not None else None
    if t == "s":
        return (shared[int(raw)] if raw is not None else None), None, formula
    if t == "inlineStr":
        is_ = c.find(_q("is"))
        text = "".join(x.text or "" for x in is_.iter(_q("t"))) if is_ is not None else None
        return text, None, formula
    if t in ("str", "e"):
        return raw, None, formula
    if t == "b":
        return (None if raw is None else ("TRUE" if raw == "1" else "FALSE")), None, formula
    if raw is None:
        return None, None, formula
    num = float(raw)
    text = str(int(num)) if num.is_integer() and "E" not in raw.upper() and "." not in raw else raw
    return text, num, formula


def iter_workbook_cells(path: str, content: bytes, sheets: Sequence[str] | None = None,
                        max_rows: int | None = None) -> Iterator[tuple]:
    """Yield ``(path, sheet, row_idx, col_idx, value, num, formula)`` for non-empty cells."""
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        shared = _shared_strings(zf)
        for name, part in _sheet_parts(zf):
            if sheets is not None and name not in sheets:
                continue
            if part not in zf.namelist():
                continue
            with zf.open(part) as fh:
                row_no = -1
                for _, el in ET.iterparse(fh, events=("end",)):
                    if el.tag != _q("row"):
                        continue
                    r_attr = el.get("r")
                    row_no = int(r_attr) - 1 if r_attr else row_no + 1
                    if max_rows is not None and row_no >= max_rows:
                        break
                    col_no = -1
                    for c in el.iter(_q("c")):
                        ref = c.get("r")
                        m = _REF.match(ref) if ref else None
                        col_no = column_index(m.group(1)) if m else col_no + 1
                        value, num, formula = _cell_value(c, shared)
                        if value is None and formula is None:
                            continue
                        yield path, name, row_no, col_no, value, num, formula
                    el.clear()


def _decode(sheets, max_rows):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buf: list[tuple] = []
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                for cell in iter_workbook_cells(path, bytes(content), sheets, max_rows):
                    buf.append(cell)
                    if len(buf) >= _BATCH:
                        yield pd.DataFrame(buf, columns=CELL_SCHEMA.names)
                        buf = []
        if buf:
            yield pd.DataFrame(buf, columns=CELL_SCHEMA.names)
    return run


def binary_files(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """``path, modificationTime, length, content`` of every matching file (recursive)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path))


def cells_from_binary(files: DataFrame, sheets: Sequence[str] | None = None,
                      max_rows: int | None = None, content_col: str = "content") -> DataFrame:
    """Decode a ``(path, content)`` DataFrame into the cell table."""
    src = files.select("path", F.col(content_col).alias("content"))
    return src.mapInPandas(_decode(list(sheets) if sheets else None, max_rows), CELL_SCHEMA)


def read_report_cells(spark: SparkSession, path: str, sheets: Sequence[str] | None = None,
                      max_rows: int | None = None, glob: str = "*.xlsx") -> DataFrame:
    """Cell table of every workbook under ``path``."""
    return cells_from_binary(binary_files(spark, path, glob), sheets, max_rows)


def _inventory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(bytes(content))) as zf:
                rows += [(path, i, name) for i, (name, _) in enumerate(_sheet_parts(zf))]
        yield pd.DataFrame(rows, columns=SHEET_SCHEMA.names)


def sheet_inventory(files: DataFrame) -> DataFrame:
    """Every sheet of every workbook, empty sheets included (reads only the workbook part)."""
    return files.select("path", "content").mapInPandas(_inventory, SHEET_SCHEMA)


def latest_file(spark: SparkSession, path: str, glob: str = "*.xlsx") -> str:
    """The lexicographically last matching file (dated names sort by date);
    raises ``FileNotFoundError`` when there is none. Only paths are read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path).select("path"))
    last = files.agg(F.max("path").alias("p")).first().p
    if last is None:
        raise FileNotFoundError(f"no {glob} under {path}")
    return last

