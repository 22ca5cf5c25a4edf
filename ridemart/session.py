"""Spark session and shared-storage helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app_name: str = "ridemart",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    UTC session zone (timestamps are zone-less), ANSI on, AQE on with
    partition coalescing and skew-join splitting, Arrow for the few pandas
    steps, and no UI server.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Remove reliable checkpoint files once nothing references them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # A reused session keeps its own settings; these two matter for results.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local-mode session without it (tests) gets a scratch
    folder; a cluster without one is an error rather than a silent
    machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ridemart-ckpt-"))
    return sc.getCheckpointDir()
