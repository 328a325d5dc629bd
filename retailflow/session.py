"""Spark session helpers.

The library never creates a session on its own inside operators; jobs and
tests call :func:`get_session`. On a cluster the session is created by the
platform and only :func:`ensure_checkpoint_dir` is used.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings that every job relies on. AQE stays on so that shuffle
# partitions are coalesced and skewed join partitions are split at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "retailflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    cpus = os.environ.get("BENCH_CPUS") or os.environ.get("RETAILFLOW_CPUS") or "8"
    builder = SparkSession.builder.appName(app_name).master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf.setdefault("spark.driver.memory", os.environ.get("RETAILFLOW_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Local runs and tests have none, so a fresh scratch folder is taken;
    a non-local session without the setting is an error, because a folder on
    the driver's disk is not visible to the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="retailflow-ckpt-")
    sc.setCheckpointDir(path)
    return path
