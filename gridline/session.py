"""Spark session helpers.

Everything runs on a stock SparkSession; these helpers only pin the settings the
operators rely on (UTC, dynamic partition overwrite, AQE) and resolve the shared
checkpoint folder from the session instead of a machine-local path.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library depends on for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",          # strict casts
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "gridline", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster use the cluster's own builder + ``ensure_conf``."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("GRIDLINE_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # checkpoint files of garbage-collected plans are removed by Spark's cleaner
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators need to an existing session. A session that
    refuses one would give wrong results (casts that don't fail, partitions wiped), so that is an error."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for cut lineage and intermediate tables.

    Read ``spark.checkpoint.dir`` from the session (the cluster names a shared folder
    there), or the folder already given to ``setCheckpointDir``. Only when neither is set and
    the master is local -- local runs and tests -- a private folder is set.
    """
    sc = spark.sparkContext
    d = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
         or sc.getCheckpointDir())
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="gridline-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scale_conf(input_bytes: int, partition_bytes: int = 512 << 20, min_partitions: int = 200) -> dict[str, str]:
    """Settings sized for an input of ``input_bytes`` (e.g. 100 TB on a large cluster).

    Shuffle partitions target ~``partition_bytes`` each so a partition fits an executor's
    memory without spilling; scans split files at the same size; AQE coalesces small
    partitions back towards that size and splits a skewed partition once it is 4x the
    median and above the advisory size. ``rank_within`` range-partitions into
    ``spark.sql.shuffle.partitions`` slices, so the same number bounds its slice size.
    """
    n = max(min_partitions, -(-input_bytes // partition_bytes))
    size = str(partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, **kw) -> SparkSession:
    for k, v in scale_conf(input_bytes, **kw).items():
        spark.conf.set(k, v)
    return spark
