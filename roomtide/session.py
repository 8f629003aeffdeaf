"""Spark session and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Session windows are merged within each task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}
# State of streams lies on the disks of the executors, not in their memory; what a batch
# changes goes to the checkpoint, not all of it.
STREAM_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def keep_stream_state(spark: SparkSession) -> None:
    """Streams that are started from now on keep their state as STREAM_STATE says."""
    for key, value in STREAM_STATE.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    Only a local master may go without the setting; it then gets a temporary
    folder. A cluster without it is refused, since a machine-local folder there
    would lose data with its machine.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") \
        or spark.conf.get("spark.checkpoint.dir", None) \
        or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="roomtide-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never reused, so retries cannot collide."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/roomtide/{app}/{name}-{uuid.uuid4().hex}"


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop the tables that are materialised inside once the block has ended."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _file_system(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; empty if there is no such folder."""
    where, files = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) \
        if files.exists(where) else []


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with `*` and `{a,b}`."""
    where, files = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in files.globStatus(where) or ())


def remove(spark: SparkSession, path: str) -> None:
    where, files = _file_system(spark, path)
    files.delete(where, True)


def materialise(df: DataFrame, name: str, outlive: bool = False) -> DataFrame:
    """Write a small intermediate table to the shared folder and read it back.

    Inside `scratch` it is dropped with the block; one that is to outlive the block, as
    its result, goes with the block around it, if there is one.
    """
    path = work_path(df.sparkSession, name)
    around = _scratch[:-1] if outlive else _scratch
    if around:
        around[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
