"""Unwrap downloaded payloads: a zip holding a workbook -> the workbook bytes.

An .xlsx is itself a zip; it is recognised by its ``[Content_Types].xml``
part and passed through unchanged. Any other zip yields its first member
ending in ``.xlsx`` (case-insensitive); a zip without one is reported in
``unwrap_error`` instead of failing the whole job, so the caller can mark
that source ``failed``.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import workbook

REPORT_GLOB = "*.{xlsx,zip}"

UNWRAP_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("payload", T.BinaryType(), True),
    T.StructField("unwrap_error", T.StringType(), True),
])


def unwrap_bytes(data: bytes) -> bytes:
    """The workbook bytes inside ``data`` (raises ``ValueError`` when there are none)."""
    buf = io.BytesIO(data)
    if not zipfile.is_zipfile(buf):
        return data
    with zipfile.ZipFile(buf) as zf:
        names = zf.namelist()
        if "[Content_Types].xml" in names:
            return data
        for name in names:
            if name.lower().endswith(".xlsx"):
                return zf.read(name)
    raise ValueError("zip archive holds no .xlsx member")


def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                rows.append((path, unwrap_bytes(bytes(content)), None))
            except (ValueError, zipfile.BadZipFile) as e:
                rows.append((path, None, str(e)))
        yield pd.DataFrame(rows, columns=UNWRAP_SCHEMA.names)


def unwrap_archives(files: DataFrame) -> DataFrame:
    """``(path, content)`` -> ``(path, payload, unwrap_error)``."""
    return files.select("path", "content").mapInPandas(_run, UNWRAP_SCHEMA)


def report_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, content)`` of every workbook below ``path``, archives unwrapped and named like
    their report (``2026_07_03.zip`` holds ``2026_07_03.xlsx``); one without a workbook raises."""
    found = unwrap_archives(workbook.binary_files(spark, path, REPORT_GLOB))
    failed = F.raise_error(F.concat("path", F.lit(": "), "unwrap_error")).cast("binary")
    return found.select(F.regexp_replace("path", r"(?i)\.zip$", ".xlsx").alias("path"),
                        F.when(F.col("unwrap_error").isNull(), F.col("payload")).otherwise(failed).alias("content"))
