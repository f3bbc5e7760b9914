"""Packed blobs for a key/value store outside Spark."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicecheck.settings import IDS_PER_CHUNK, SLICE, passing_tables
from slicecheck.sinks.packed import blob_lines, packed_blobs
from slicecheck.sources import keyed


class Store(Protocol):
    def set(self, key: str, value: bytes) -> None: ...

    def close(self) -> None: ...


def put_blobs(
    blobs: DataFrame, connect: Callable[[], Store], by: Sequence[str] = SLICE
) -> None:
    """Sets each text of ``packed_blobs``, compressed, under ``slice:part``. Every task
    opens one client and streams its rows through it. A task that is run again
    sets the same keys to the same values.
    """
    names = [*by, "part"]

    def put(rows):
        client = connect()
        try:
            for row in rows:
                key = ":".join(str(row[name]) for name in names)
                client.set(key, zlib.compress(row["text"].encode()))
        finally:
            client.close()

    blobs.foreachPartition(put)


def export_blobs(
    df: DataFrame,
    columns: Sequence[str],
    connect: Callable[[], Store],
    by: Sequence[str] = SLICE,
    size: int = IDS_PER_CHUNK,
) -> None:
    """Packs and sets the rows of ``df``; tables in between are removed at the end."""
    with passing_tables(df.sparkSession):
        put_blobs(packed_blobs(df, columns, by, size), connect, by)


def blob_key(by: Sequence[str] = SLICE) -> Column:
    return F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in [*by, "part"]])


def save_blobs(
    blobs: DataFrame, path: str, by: Sequence[str] = SLICE, mode: str = "append"
) -> None:
    """The texts of ``packed_blobs`` as keyed rows in files, under the keys of ``put_blobs``.
    They are there together once all of them are written."""
    keyed.register(blobs.sparkSession)
    rows = blobs.select(blob_key(by).alias("key"), *by, "part", "text")
    rows.write.format("keyed").mode(mode).save(path)


def read_blobs(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """What ``save_blobs`` wrote, all of it or under one key."""
    keyed.register(spark)
    reader = spark.read.format("keyed")
    return (reader if key is None else reader.option("key", key)).load(path)


def read_blob_lines(spark: SparkSession, path: str, by: Sequence[str] = SLICE) -> DataFrame:
    """The lines of all texts, ``by, part, line_no, line``."""
    return blob_lines(read_blobs(spark, path), by)
