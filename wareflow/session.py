"""Session settings and the shared scratch location.

Scratch output (sink round trips, table swaps, staged writes) always goes
under the folder the cluster names in ``spark.checkpoint.dir``. That folder is
shared by every executor (HDFS/S3/NFS on a cluster). Only when a session has
no such setting (unit tests, a laptop) do we create one and register it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every wareflow job relies on; all are runtime (session) settings.
JOB_SETTINGS = {
    # Partition values stay text (stored columns are all strings).
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Oracle comparison and `date_format` must not depend on the host zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch to broadcast when a side measures small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`JOB_SETTINGS` to an existing session."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "wareflow") -> SparkSession:
    """A local session for tests and benches (no UI, no server)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in JOB_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; set one only when it is unset (tests, local runs).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # spark.checkpoint.dir is a static setting; register the folder on the
        # context instead (later calls read it back from getCheckpointDir).
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wareflow-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/wareflow/{name}-{uuid.uuid4().hex[:12]}"
