"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# What a large cluster run wants on top of Spark's defaults. Skewed join
# partitions are split at run time, small shuffle partitions are merged, and a
# side is broadcast only when its measured size is below the threshold.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the cluster settings.

    Capturing the Python call site of every column expression is switched off:
    it costs milliseconds per expression, and models have hundreds.
    """
    builder = SparkSession.builder.appName(app).config(
        "spark.python.sql.dataFrameDebugging.enabled", "false"
    )
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; every time-of-day rule below assumes UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the cluster settings; size shuffles from the input volume.

    About 200 MB of shuffled input per partition keeps sorts and hash maps in
    executor memory; AQE merges what turns out smaller.
    """
    for key, value in CLUSTER_SETTINGS.items():
        spark.conf.set(key, value)
    if input_bytes:
        wanted = max(spark.sparkContext.defaultParallelism, input_bytes // (200 << 20))
        spark.conf.set("spark.sql.shuffle.partitions", str(int(wanted)))
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Where that setting is absent, a temporary folder is used on a ``local[...]``
    master, and any other master is an error.
    """
    return os.path.join(ensure_checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, set where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="transitlake-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root
