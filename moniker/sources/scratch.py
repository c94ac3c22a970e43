"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


_JOB: ContextVar[str] = ContextVar("job", default="")


def _file_system(spark: SparkSession, path: str) -> tuple:
    """The file system of a path and the path, of the JVM."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()), own


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    system, own = _file_system(spark, path)
    system.delete(own, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, own = _file_system(spark, path)
    return system.exists(own)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders in a folder."""
    system, own = _file_system(spark, path)
    return [entry.getPath().toString() for entry in system.listStatus(own) if entry.isDirectory()]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, which may be a pattern; none are opened."""
    system, own = _file_system(spark, path)
    return sum(system.getContentSummary(found.getPath()).getLength() for found in system.globStatus(own) or [])


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder. Raises ``OSError`` where that is not possible."""
    system, own = _file_system(spark, path)
    if not system.rename(own, _file_system(spark, target)[1]):
        raise OSError(f"{path} cannot be renamed to {target}")


@contextmanager
def scratch_job(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end, also after a failure."""
    token = _JOB.set(f"job-{uuid.uuid4().hex}/")
    folder = f"{_base(spark)}/moniker/{_JOB.get()}"
    try:
        yield
    finally:
        _JOB.reset(token)
        delete(spark, folder)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="moniker-")


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _local_folder()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, in the folder of the job if one is open.

    Only where the session names no such folder, as in a local test, is one made
    on this machine.
    """
    return f"{_base(spark)}/moniker/{_JOB.get()}{name}-{uuid.uuid4().hex}"


def settle(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Write what ``build`` gives and read it back; the intermediate tables made on the way are deleted."""
    path = scratch_path(spark, name)
    with scratch_job(spark):
        made = build()
        made.write.parquet(path)
        schema = made.schema
    return spark.read.schema(schema).parquet(path)


# Shuffle files of an execution go when it ends, not when the driver happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside are deleted as soon as it is written. The plan of a write is run once only."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


def store(df: DataFrame, path: str, mode: str = "errorifexists", by: Sequence[str] = ()) -> None:
    """Write ``df`` densely packed, and leave nothing else on the disk."""
    with released(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").partitionBy(*by).parquet(path)


def packed(df: DataFrame, name: str) -> DataFrame:
    """``materialise`` for what may be large."""
    return gathered([df], name)


def gathered(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """Frames of one schema, written one after the other, as one table. Only the shuffle files of one of them are there at a time."""
    path = None
    for df in frames:
        spark, schema = df.sparkSession, df.schema
        path = path or scratch_path(spark, name)
        store(df, path, "append")
    return spark.read.schema(schema).parquet(path)


@contextmanager
def refilled(spark: SparkSession, path: str, column: str) -> Iterator[Callable[[DataFrame], None]]:
    """A function that adds rows to new folders by ``column`` below ``path``.

    Once all is written they take the places of those of the same value; other folders stay as
    they are. After a failure all are as before.
    """
    root = path.rstrip("/")
    staged = f"{root}/_staged-{uuid.uuid4().hex}"
    try:
        yield lambda df: store(df, staged, "append", [column])
        for fresh in folders(spark, staged) if exists(spark, staged) else []:
            own = f"{root}/{fresh.rsplit('/', 1)[-1]}"
            delete(spark, own)
            move(spark, fresh, own)
    finally:
        delete(spark, staged)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    For results that several branches of a plan use: the written table cuts the
    lineage, survives the loss of executors and is columnar, so that each branch
    reads only its columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
