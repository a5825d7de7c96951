"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build(app: str = "larder", master: str | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution, UTC time and RocksDB streaming state.

    Shuffle partition counts stay with the cluster: adaptive execution coalesces
    a generous ``spark.sql.shuffle.partitions`` and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Bytes of a stored table that a task reads at once, and of a shuffle that a task takes.
TASK_BYTES = 32 * 2 ** 20
#: Bytes of stored input to a first shuffle partition; adaptive execution puts small ones together.
PARTITION_BYTES = 4 * 2 ** 20


def sized(spark: SparkSession, folder: str) -> int:
    """Lets the number of tasks grow with the tables in ``folder``, and not the memory of one.

    A fixed number of shuffle partitions gives each task its share of the input, however large.
    Here shuffles start with partitions by the input's size, the session's own number at least.  Task
    sizes that the session states itself are kept.  Streams keep their number of state stores.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    # each entry by what it points to: a folder's own summary has links at the length of their names
    found = sum(files.getContentSummary(status.getPath()).getLength()
                for status in files.listStatus(place))
    first = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-found // PARTITION_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", first)
    for name in ("spark.sql.files.maxPartitionBytes",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, TASK_BYTES)
    return first


#: For plans that run once, as writes do: their shuffle files go when they end, not when the driver
#: next collects garbage.
FREEING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def using(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Holds session settings for a while."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``, which whoever makes the session sets.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/larder/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage, whatever file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
