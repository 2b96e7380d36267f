"""Cutting lineage in the shared folder that the cluster names."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.session import checkpoint_dir


def checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` written to the reliable checkpoint folder and read again: survives lost executors."""
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker gets at once, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


@contextmanager
def within_small_batches(spark: SparkSession) -> Iterator[None]:
    """``small_batches`` for the jobs run inside; the session's own settings hold again afterwards."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    own = {name: spark.conf.get(name, None) for name in names}
    small_batches(spark)
    try:
        yield
    finally:
        for name, value in own.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now; it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
