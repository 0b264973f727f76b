"""Session helpers.

The library never creates a session on its own: callers (tests, ``bench.py``) use
:func:`local_session`; library code only *reads* settings from the session it is given.
"""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "seasonflow", extra: dict | None = None) -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast decisions on measured sizes only: no estimate-based static
        # broadcast; AQE converts a join at run time from actual shuffle sizes.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions_for(shuffle_bytes: float, target_bytes: int = 256 * 1024 ** 2) -> int:
    """Partitions so that the largest expected shuffle gives ~``target_bytes`` per task."""
    return max(1, math.ceil(shuffle_bytes / target_bytes))


def recommended_conf(shuffle_partitions: int | None = None, shuffle_bytes: float | None = None,
                     target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings this library is designed for on a cluster (the caller owns the session).

    Give either a partition count or the size of the largest expected shuffle; e.g. at
    100 TB the sell-out's projected line-item shuffle is roughly 20 TB, which at 256 MB
    per task is ~80k partitions. AQE then coalesces small ones and splits skewed ones,
    so tasks stay near the target size and fit in executor memory.
    """
    if shuffle_partitions is None:
        shuffle_partitions = (shuffle_partitions_for(shuffle_bytes, target_partition_bytes)
                              if shuffle_bytes else 2000)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring the SparkContext if needed.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file system
    the cluster names). Only a *local* session with no setting gets a scratch folder of
    its own; a cluster session without the setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a shared folder (HDFS/S3/...)")
        configured = tempfile.mkdtemp(prefix="seasonflow-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, on the file system it names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this session has written under the shared checkpoint folder.

    Spark makes a folder of its own there for every context, so nothing of another
    session is touched. Results that were not saved elsewhere can't be read afterwards.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        path = spark._jvm.org.apache.hadoop.fs.Path(current)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
        sc.setCheckpointDir(current.rstrip("/").rsplit("/", 1)[0])
