"""Session set-up and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stored tables hold JSON texts, which take half the bytes of Spark's own choice.
    "spark.sql.parquet.compression.codec": "zstd",
    # State of streams lies on disk, and a batch writes what it changed.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# What only the start of a session can set. Rows of texts shuffle to little more than half the bytes of lz4, Spark's own choice.
START = {"spark.io.compression.codec": "zstd"}

# Bytes one task gets after a shuffle, if Spark puts small parts together, in queries that bound the memory of a task. Rows take many times
# their shuffled size when they are sorted. Smaller tasks reduce their own rows less, so they shuffle more.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}
# Whether Spark deletes the shuffle files of a command when it is done.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Stored bytes of the tables for which a shuffle gets one part, at least.
PART_BYTES = 16 << 20


def build(app: str = "tallyloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START, **SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """Give a session somebody else started the settings it does not name itself."""
    named = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not named.contains(key):
            spark.conf.set(key, value)


def fit_tasks(spark: SparkSession, paths: Sequence[str] | None) -> None:
    """Small tasks for a query over these files, unless the session names their size itself; without files Spark's usual ones.

    The parts of a shuffle grow in number with the files instead of growing in size; small ones are put together at run time.
    """
    wanted = dict.fromkeys([*TASK_BYTES, PARTITIONS])
    if paths is not None:
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = {**TASK_BYTES, PARTITIONS: str(max(usual, -(-_stored_bytes(spark, paths) // PART_BYTES)))}
    named = spark.sparkContext.getConf()
    for key, value in wanted.items():
        if named.contains(key):
            continue
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def _stored_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    found = 0
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(at):
            found += files.getContentSummary(at).getLength()
    return found


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = os.path.join(tempfile.gettempdir(), "tallyloom")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_folder(spark)}/tallyloom-scratch/{label}-{uuid.uuid4().hex}"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of writes inside go as soon as each write is done, not only when Spark forgets its plan.

    A run of many writes then needs the disk of the largest one. Frames that are made inside and read afterwards may do stages again.
    """
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(TIDY)
        else:
            spark.conf.set(TIDY, before)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Rows that are written once, as compressed columns, and read as often as needed; the same ones each time."""
    with tidy(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder, so that a lost executor cannot change the rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
