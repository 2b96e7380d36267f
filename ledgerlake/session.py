"""Spark session settings shared by jobs, tests and the bench.

Cluster jobs receive a session from the launcher; ``configure`` only fills in
settings that are unset, so cluster-provided values (shuffle partitions,
checkpoint directory, ...) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on: ANSI casts (strict parsing raises), UTC
# session time, AQE for runtime re-planning (coalescing, skew-join splitting,
# SMJ -> BHJ conversion once a side's real size is known).
DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files (surrogate-key numbering, stream batch snapshots) are
    # removed from the shared folder once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "ledgerlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local/test builder. On a cluster use the launcher's session + ``configure``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply runtime SQL defaults that the session does not already set."""
    for k, v in DEFAULTS.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session leaves it unset (local tests) do we create a private
    scratch folder; a cluster always names a shared, durable location.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster must name a shared, durable folder")
        # Local runs (tests) only: a private scratch folder.
        conf_dir = tempfile.mkdtemp(prefix="ledgerlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``; a failing file system raises instead of looking like an absent table."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this job wrote."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
