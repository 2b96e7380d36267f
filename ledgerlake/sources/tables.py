"""Parquet tables of a data directory (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def ntz(ts: str):
    """A ``TIMESTAMP_NTZ`` literal (the test tables store naive timestamps)."""
    return F.to_timestamp_ntz(F.lit(ts))
