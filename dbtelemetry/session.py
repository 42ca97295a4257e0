"""Spark session settings used by tests, the bench and local runs.

On a cluster the session is created by the platform; these helpers only fill
in settings that are unset, so a cluster's own values always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator relies on. AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is under the threshold), splits
# skewed sort-merge-join partitions and coalesces small shuffle partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Partition sizing for large inputs: ~256 MB scan splits and shuffle
    # partitions that AQE coalesces towards 256 MB, so tasks fit executor
    # memory without spilling on typical 4-8 GB executor slices.
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "dbtelemetry", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    from dbtelemetry import ship_to_executors

    ship_to_executors(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there, and is refused without one:
    executors and driver share no machine-local folder. Only a local
    session (tests) gets a scratch folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by driver and executors")
        current = tempfile.mkdtemp(prefix="dbtelemetry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current
