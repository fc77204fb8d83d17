"""Session helpers: build a local session for tests and find the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "meridian") -> SparkSession:
    """A local session with AQE on and the UI off (tests, bench, smoke runs)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in _DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("MERIDIAN_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). When neither is
    set, a session on one machine (``local[n]``, as in tests) gets a folder of its own and
    any other session an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        try:
            found = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
            found = None
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="meridian-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder name under the shared dir (one per run, never reused)."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
