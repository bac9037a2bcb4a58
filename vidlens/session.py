"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "vidlens",
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    Only deployment-neutral settings live here: AQE on (runtime coalescing,
    skew-join splitting, broadcast conversion from measured sizes), UTC
    session time, no web UI.  Cluster sizing belongs to the submitter.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Suggested settings for a large cluster (~100 TB input, ~1000 executors).
# Not applied by the library; pass them to ``get_spark(conf=...)`` or the
# submit command.  AQE starts from many shuffle partitions and coalesces them
# to ~256 MB, splits skewed join partitions, and the scan packs files into
# ~256 MB splits.
LARGE_CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage.
    Only in local mode, as in tests, is one created and registered where it is
    unset; elsewhere that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # core configs cannot be set at runtime; register the folder instead
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vidlens-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/vidlens/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A fresh folder under the shared checkpoint folder that is deleted on leaving.

    For tables that are read only inside the ``with`` block, also when it
    fails.  A DataFrame that outlives the block must not read the folder.
    """
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
