"""Session settings and the shared folder for checkpoints and stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Nothing here grows with the data; the one setting that does is `shuffle_partitions` below.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a reduce partition that one key has filled, whatever its size.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keeps stream state out of the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def shuffle_partitions(shuffled_bytes: int, target: int = 128 << 20) -> int:
    """Partitions that hold ``target`` bytes each: a starting number, which AQE lowers as needed.

    AQE merges small partitions but makes no more than the session starts with,
    so size this for the largest shuffle (folded rows, not the raw log).
    """
    return max(200, -(-shuffled_bytes // target))


def build(master: str | None = None, app: str = "tidegauge", **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots.

    On a cluster pass ``spark__sql__shuffle__partitions``, see :func:`shuffle_partitions`.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one process, may fall back to a
    temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidegauge-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
