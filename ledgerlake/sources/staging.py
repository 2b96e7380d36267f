"""Staging zone: flat tables between extraction, cleaning and loading.

Staged as Parquet with the DataFrame's explicit schema (CSV would turn both
NULL and ``''`` into empty fields and read them back as NULL). Header CSV with
every column read as text is supported for files produced elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_staging(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Replace the staged table at ``path``."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_staging(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A staged Parquet table (schema optional: Parquet carries it)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header CSV with every column as text - never inferred, so codes like ``'08'`` stay text."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)
