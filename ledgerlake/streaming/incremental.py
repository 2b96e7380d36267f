"""Incremental ingest of newly landed report files with Structured Streaming.

``readStream.format("binaryFile")`` over the landing zone with
``trigger(availableNow=True)`` processes whatever arrived since the last run
and stops; nothing new means no batch at all. Each micro-batch:

1. unwraps archives and hashes the payload;
2. classifies every file: ``failed`` (unreadable, no date in its name, no
   manifest template for the source, another file of its date), ``duplicate``
   (content already in the manifest, or taken from another file of the batch),
   ``nothing_new``
   (dated at or before the source's high-water mark: late data is ignored),
   else ``new``;
3. loads the new files into the warehouse (idempotent anti-join + append);
4. appends their manifest entries, then the status rows.

Load before manifest: a batch replayed after a crash reloads nothing twice
(the load is insert-if-absent) and still records the manifest entries.
Inside ``foreachBatch`` only the batch's own session is used and every table
is re-read by path, so appends made by earlier batches are always visible.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions import web
from ..plans import reports
from ..plans.warehouse import Warehouse
from ..session import checkpoint_dir, path_exists
from ..sources import archives, manifest, workbook
from . import status as st

STATUS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("report_date", T.DateType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("reason", T.StringType()),
])

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

_DATE_IN_NAME = r"([0-9]{4}_[0-9]{2}_[0-9]{2})"


def classify_files(files: DataFrame, entries: DataFrame | None, source: str) -> DataFrame:
    """``files(path, payload, unwrap_error)`` -> + report_date, sha256, status, reason."""
    f = files.select(
        F.lit(source).alias("source"), "path", "payload", F.col("unwrap_error").alias("error"),
        F.try_to_date(F.regexp_extract(web.base_name("path"), _DATE_IN_NAME, 1), "yyyy_MM_dd").alias("report_date"),
        web.sha256_hex("payload").alias("sha256"))
    if entries is None:
        entries = manifest.entries_from_rows(files.sparkSession, [])
    # Other sources' entries count for the bytes only, so a source is matched by its own name.
    return st.landed_status(f, entries).drop("error").select("source", "path", "payload", "report_date", "sha256", "status", "reason")


class IncrementalIngest:
    """One dated source landing under ``landing``; warehouse, manifest and status
    tables under shared folders; ``checkpoint`` is the stream's progress log."""

    def __init__(self, spark: SparkSession, landing: str, warehouse_root: str, manifest_path: str,
                 status_path: str, checkpoint: str, source: str = "CGD", raw_path: str | None = None,
                 max_files: int = 10_000):
        self.spark, self.landing, self.source = spark, landing, source
        self.warehouse_root, self.manifest_path = warehouse_root, manifest_path
        self.status_path, self.checkpoint = status_path, checkpoint
        self.raw_path, self.max_files = raw_path, max_files

    def seed_manifest(self, entries: DataFrame) -> None:
        """Initial lineage (e.g. from the JSON manifest document)."""
        manifest.append_entries(entries, self.manifest_path)

    def _batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files = archives.unwrap_archives(batch.select("path", "content"))
        entries = manifest.read_manifest_table(spark, self.manifest_path)
        # Materialised once (reliable checkpoint in the shared folder): the status
        # must reflect the manifest as it was *before* this batch appends to it.
        checkpoint_dir(spark)
        classified = classify_files(files, entries, self.source).checkpoint(eager=True)
        new = classified.filter(F.col("status") == st.NEW)
        if not new.isEmpty():
            template = manifest.latest_per_source(entries.filter(F.col("source") == self.source))
            fresh = manifest.build_entries(new.select("source", "report_date", "sha256"), template)
            base = entries.select(F.coalesce(F.max("ordinal"), F.lit(-1))).scalar()
            # Ordinals continue the manifest; the window spans only this batch's new files.
            fresh = fresh.withColumn("ordinal", base + F.dense_rank().over(
                Window.orderBy("report_date", "sha256")).cast("long"))
            if self.raw_path:
                # Raw zone: the unwrapped bytes of every new report, partitioned by source;
                # a replayed batch only adds hashes the raw table does not hold yet.
                raw = new.select("source", "report_date", "sha256", "payload")
                if path_exists(spark, self.raw_path):
                    raw = raw.join(spark.read.schema("sha256 string").parquet(self.raw_path), "sha256", "left_anti")
                raw.write.mode("append").partitionBy("source").parquet(self.raw_path)
            wh = Warehouse(spark, self.warehouse_root)
            # Reports are keyed by their canonical, date-derived file name (the same
            # name the manifest entry records), whatever the landed file was called.
            landed = new.select(cal.report_file_name("report_date").alias("path"), F.col("payload").alias("content"))
            reports.run_reports(wh, landed, None, fresh,
                                lambda fs, sheet: workbook.cells_from_binary(fs, sheets=[sheet]))
            # Replays must not duplicate lineage: only hashes not yet in the manifest are appended.
            fresh = fresh.join(entries.select("sha256"), "sha256", "left_anti")
            manifest.append_entries(fresh, self.manifest_path)
        (classified.select(F.lit(self._run_id).alias("run_id"), F.lit(batch_id).cast("long").alias("batch_id"), "source", "path", "report_date",
                           "sha256", "status", "reason")
         .write.mode("append").parquet(self.status_path))

    def run(self) -> DataFrame:
        """Process everything landed since the last run; returns this run's status rows."""
        self._run_id = uuid.uuid4().hex
        stream = (self.spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
                  .option("pathGlobFilter", archives.REPORT_GLOB)
                  .option("maxFilesPerTrigger", self.max_files).option("recursiveFileLookup", "true")
                  .load(self.landing))
        q = (stream.writeStream.foreachBatch(self._batch).option("checkpointLocation", self.checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        out = self._status()
        if out is None:
            return self.spark.createDataFrame([], STATUS_SCHEMA)
        return out.filter(F.col("run_id") == self._run_id)

    def _status(self) -> DataFrame | None:
        if not path_exists(self.spark, self.status_path):  # no run has written status yet
            return None
        return self.spark.read.schema(STATUS_SCHEMA).parquet(self.status_path)


def status_by_source(status: DataFrame) -> DataFrame:
    """One outcome per source and run: failed > new > duplicate > nothing_new."""
    rank = F.array_position(F.array(*[F.lit(x) for x in (st.FAILED, st.NEW, st.DUPLICATE, st.NOTHING_NEW)]),
                            F.col("status"))
    return (status.groupBy("run_id", "source").agg(F.min_by("status", rank).alias("status"),
                                                     F.max("report_date").alias("latest_report_date")))

