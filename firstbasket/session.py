"""SparkSession settings used by the tests, the bench and the examples.

On a cluster the session comes from the platform; ``configure`` only sets
what is unset, and ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
session; a scratch folder stands in on a local master only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "firstbasket",
                  extra_conf: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**LOCAL_DEFAULTS, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on (UTC, AQE) without overriding a cluster's choices."""
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
                "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, LOCAL_DEFAULTS[key])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``), or a local
    scratch folder when the setting is unset and the master is local (tests and benches). Elsewhere
    an unset folder is an error: executors would write to disks that others don't see."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions expose no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="firstbasket-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def cluster_settings(input_bytes: int, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings to apply on a cluster for a run over ``input_bytes`` of Parquet.

    Shuffle partitions start at roughly one per ``target_partition_bytes`` of input (at least
    three waves of the available cores) and AQE coalesces them from measured sizes; skewed
    partitions (five times the median and over 256 MB) are split by AQE's skew join.
    """
    partitions = max(3 * executor_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
