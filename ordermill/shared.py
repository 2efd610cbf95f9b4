"""Shared storage for intermediate tables, and the size check before a broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Result = TypeVar("Result")

# What a failed job raises; failures that PySpark has no class for come as they are.
JobFailure = (PySparkException, Py4JJavaError)

# Bytes that a broadcast side may have, as its rows are counted while it is written.
BROADCAST_BYTES = 64_000_000

# Rows of a shuffle that make a partition of some 100 MB.
PARTITION_ROWS = 500_000

_local_folders: dict[str, str] = {}
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors can all reach: spark.checkpoint.dir.

    Only a local-mode session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="ordermill-")
    return _local_folders[app]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{_scratch.get() or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder for all intermediate tables that are made inside; it is deleted at the end."""
    folder = new_folder(spark, label)
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        discard(spark, folder)


def cut(df: DataFrame, label: str = "cut", path: str | None = None) -> DataFrame:
    """Write df as Parquet to shared storage once and go on from the files.

    The result no longer depends on executors staying alive, later reads prune
    columns, and the optimizer knows its size from the files.
    """
    path = path or new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def storage(spark: SparkSession, path: str):
    """The path and its file system, whatever storage it is on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = storage(spark, path)
    return system.exists(folder)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    folder, system = storage(spark, path)
    system.delete(folder, True)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file with this content."""
    place, system = storage(spark, path)
    out = system.create(place, True)
    out.write(bytearray(content))
    out.close()


def replace_file(spark: SparkSession, folder: str, path: str) -> None:
    """Put the only data file below a folder in the place of a file."""
    place, system = storage(spark, path)
    found = system.listFiles(storage(spark, folder)[0], True)
    while found.hasNext():
        made = found.next().getPath()
        if not made.getName().startswith(("_", ".")):
            system.delete(place, False)
            system.rename(made, place)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """df, and an observation that gets its number of rows when it is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory: its texts and 16 bytes for every column."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType == T.StringType()]
    return sum(texts, F.lit(16 * len(df.columns)))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Evaluate df once and hint it for broadcast if it has at most max_bytes bytes.

    A larger one is returned without a hint and joins by shuffle, where adaptive
    execution splits the hot keys.
    """
    seen = Observation()
    size = F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes")
    fixed = cut(df.observe(seen, size), "small")
    return F.broadcast(fixed) if seen.get["bytes"] <= max_bytes else fixed


def together(jobs: Iterable[Callable[[], Result]]) -> list[Result]:
    """Run independent jobs at the same time, so that small ones share the cluster."""
    jobs = list(jobs)
    if not jobs:
        return []
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = [pool.submit(copy_context().run, job) for job in jobs]
        return [job.result() for job in running]


@contextmanager
def shuffles_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Start shuffles with enough partitions for rows; adaptive execution merges small ones.

    It merges but does not split them, unless they are skewed, so a fixed number would
    be too small for large loads.
    """
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    fewest = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(name, str(max(fewest, rows // PARTITION_ROWS)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
