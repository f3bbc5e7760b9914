"""Values and session settings shared by the package."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# They decide the verdicts and must not be changed lightly.
TOLERANCE = 0.01
THRESHOLD = 0.99
KPI_PATTERN = "^i[0-9]+$"
ENTITY = "mo"
# Tells in facts which keys were there but no whole numbers.
BAD_KEY = "_bad_key"
KEYS_PER_BATCH = 1000
IDS_PER_CHUNK = 5000
STATUS_PASS = 1
STATUS_MISMATCH = -1
STATUS_FAILED = 2
STATUS_RUNNING = 3

# One slice of a KPI table: which model, at which granularity, on which day, in which slot.
SLICE = ["motype", "period", "sd", "st"]


_owners: list[list[str]] = []


def passing_path(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, for what ``passing_tables`` removes."""
    path = f"{ensure_checkpoint_dir(spark)}/{uuid4().hex}"
    if _owners:
        _owners[-1].append(path)
    return path


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there, so that
    every plan built on it sees the same rows, also after executors are lost. Being
    a table, it is read by column and its size is known to the planner.
    """
    path = passing_path(df.sparkSession)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """What ``written`` and ``passing_path`` make inside is removed at the end, for callers that
    have written their results elsewhere by then.
    """
    _owners.append([])
    try:
        yield
    finally:
        for path in _owners.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in any store that Spark can write to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder named by the cluster; a temporary one in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="slicecheck-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()
