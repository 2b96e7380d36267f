"""The lineage manifest: one entry per downloaded file, append-only.

The initial manifest is a JSON document ``{"files": [ {...}, ... ]}``; new
entries are appended to a Parquet table instead of rewriting the document.
Dated sources carry ``report_date``; yearly sources ``fiscal_year_be``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions import web
from ..operators import dedup, joins
from ..session import path_exists

ENTRY_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("source_name_th", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("local_path", T.StringType()),
    T.StructField("report_date", T.StringType()),
    T.StructField("fiscal_year_be", T.IntegerType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("downloaded_at", T.StringType()),
    T.StructField("downloaded_by", T.StringType()),
])
DOCUMENT_SCHEMA = T.StructType([T.StructField("files", T.ArrayType(ENTRY_SCHEMA))])
TABLE_SCHEMA = T.StructType([*ENTRY_SCHEMA.fields, T.StructField("ordinal", T.LongType())])
TABLE_COLUMNS = TABLE_SCHEMA.names
SALT_BUCKETS = 32  # a source's reports are dealt to so many reducers: few sources hold all reports


def read_manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest document with their position (``ordinal``) in it."""
    doc = spark.read.option("multiLine", True).schema(DOCUMENT_SCHEMA).json(path)
    return doc.select(F.posexplode("files").alias("ordinal", "e")).select("e.*", F.col("ordinal").cast("long"))


def entries_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Entries given as Python dicts (tests, small administrative edits)."""
    data = [tuple(r.get(f) for f in ENTRY_SCHEMA.names) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, TABLE_SCHEMA)


def read_manifest_table(spark: SparkSession, path: str) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    return spark.read.schema(TABLE_SCHEMA).parquet(path).select(*TABLE_COLUMNS)


def append_entries(entries: DataFrame, path: str) -> None:
    """Append new entries; existing ones are never touched."""
    entries.select(*TABLE_COLUMNS).write.mode("append").partitionBy("source").parquet(path)


def latest_per_source(entries: DataFrame) -> DataFrame:
    """Newest entry of every source (by date, or by fiscal year for yearly
    sources); ties keep the earliest entry, never the manifest's order."""
    e = entries.withColumn("_d", F.to_date("report_date"))
    return dedup.latest_per_key(e, "source", ["_d", "fiscal_year_be"], tie="ordinal").drop("_d")


def known_dates(entries: DataFrame) -> DataFrame:
    """Per source: the newest report date already ingested (NULL when none)."""
    return entries.groupBy("source").agg(F.max(F.to_date("report_date")).alias("hwm"))


def build_entries(reports: DataFrame, template: DataFrame, downloaded_by: str = "auto") -> DataFrame:
    """New manifest entries for fetched reports.

    ``reports(source, report_date DATE, sha256)`` are the chosen reports, one row
    each, and ``template`` the latest entry per source, which supplies the source's
    name and URL. A source without a template gets no entry (inner join). The template
    is an aggregate by source, which AQE can't split a hot source against: salted.
    """
    t = template.select("source", "source_name_th", "source_url")
    fname = cal.report_file_name("report_date")
    return (joins.lookup_join(reports.select("source", "report_date", "sha256"), t, "source", salt_buckets=SALT_BUCKETS)
            .select("source", "source_name_th", "source_url",
                    F.concat(F.lit("raw/"), F.lower("source"), F.lit("/"), fname).alias("local_path"),
                    F.date_format("report_date", "yyyy-MM-dd").alias("report_date"),
                    F.lit(None).cast("int").alias("fiscal_year_be"), "sha256",
                    F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("downloaded_at"),
                    F.lit(downloaded_by).alias("downloaded_by")))
