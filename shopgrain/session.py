"""Session settings and the durable scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
PARTITIONS_CONF = "spark.sql.shuffle.partitions"
SPLIT_CONF, DEFAULT_SPLIT, SPLIT = "spark.sql.files.maxPartitionBytes", "134217728b", "32m"
ADAPTIVE_CONF = "spark.sql.adaptive.enabled"
FREE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
_STORES = "org.apache.spark.sql.execution.streaming.state"
DEFAULT_STORE = f"{_STORES}.HDFSBackedStateStoreProvider"  # all of the state in the heap
_ROCKS = "spark.sql.streaming.stateStore.rocksdb"
DISK_STORE = {
    STORE_CONF: f"{_STORES}.RocksDBStateStoreProvider",
    # At the end of a batch a partition's changes go to disk; else those of idle partitions fill the memory.
    f"{_ROCKS}.changelogCheckpointing.enabled": "false",
    f"{_ROCKS}.boundedMemoryUsage": "true",  # of all partitions of an executor together
    f"{_ROCKS}.maxMemoryUsageMB": "300",
    f"{_ROCKS}.trackTotalNumberOfRows": "false",  # it costs a lookup a row
}
TASK_ROWS = 500_000  # about what one task sorts at once


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "shopgrain") -> SparkSession:
    """A session for tests and the local bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def durable_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    names none gets a temporary folder; on a cluster that would not survive the
    loss of a machine, so it is refused there.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    if not named:
        current = context.getCheckpointDir()
        if current:
            return current
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="shopgrain-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder name under the durable root."""
    return f"{durable_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so a lost executor cannot
    re-run a non-deterministic partitioning with another outcome."""
    durable_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: the same as ``durable``, but columnar, so
    that what reads it reads the columns it needs."""
    spark = df.sparkSession
    folder = fresh_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions for so many rows: the session's, or more, so that a task holds no more
    as the table grows."""
    return max(int(spark.conf.get(PARTITIONS_CONF)), -(-rows // TASK_ROWS))


@contextmanager
def shuffle_partitions(spark: SparkSession, number: int) -> Iterator[None]:
    """The session's shuffle partitions while it is open."""
    with setting(spark, PARTITIONS_CONF, number):
        yield


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Smaller pieces of files a task while it is open, unless the session asks for others than
    the default, for tasks that keep much of what they read."""
    asked = spark.conf.get(SPLIT_CONF)
    with setting(spark, SPLIT_CONF, SPLIT if asked == DEFAULT_SPLIT else asked):
        yield


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that are started while it is open keep their state on the executors' disks, with a
    bounded part of it in memory, unless the session asks for another store than the default or
    for other bounds. A stream that goes on from a checkpoint stays with the store it began with."""
    with ExitStack() as kept:
        if spark.conf.get(STORE_CONF) == DEFAULT_STORE:
            for name, value in DISK_STORE.items():
                if name == STORE_CONF or spark.conf.get(name, None) is None:
                    kept.enter_context(setting(spark, name, value))
        yield


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run while it is open go at its end, not when the driver happens to
    collect its garbage. For frames that are run once: if run again, the files are made anew."""
    with setting(spark, FREE_CONF, "true"):
        yield


@contextmanager
def setting(spark: SparkSession, name: str, value: str | int) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
