"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: small partitions are merged, skewed join partitions are split,
    # and a side is broadcast only after its real size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The streaming state lives off-heap on the executors and only changes are uploaded.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Apply the recommended settings to a session builder.

    ``shuffle_partitions`` should be about (shuffled bytes / 128 MB); adaptive execution
    merges what turns out too small. Stateful streams keep the number they started with.
    """
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder


#: For streams whose state is as large as their input: on the executors' disks, with one bound on the memory
#: of all stores of an executor and no lookup per write to count rows. A batch changes most of such a state, so
#: a log of the changes would only be written on top.
STATE_ON_DISK = {k: v for k, v in RECOMMENDED.items() if ".stateStore." in k} | {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1500",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state on disk; the settings of the session come back after."""
    before = {k: spark.conf.get(k, None) for k in STATE_ON_DISK}
    for key, value in STATE_ON_DISK.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables: ``spark.checkpoint.dir``, which a cluster
    sets to a folder that all executors share, or else one in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
