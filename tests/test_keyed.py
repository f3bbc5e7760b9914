"""Keyed rows: what is read is what was written, whole or not at all."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slicecheck.sinks.packed import blob_lines
from slicecheck.sinks.store import read_blobs, save_blobs
from slicecheck.sources import keyed

SCHEMA = "key string, field string, value binary"


@pytest.fixture
def path(spark, tmp_path):
    keyed.register(spark)
    return f"file:{tmp_path}/table"


def save(df, path, mode="append"):
    df.write.format("keyed").mode(mode).save(path)


def load(spark, path, **options):
    return spark.read.format("keyed").options(**options).load(path)


def files_of(path) -> list[Path]:
    return list(Path(path.removeprefix("file:"), "rows").glob("*"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_all_rows_and_one_key(spark, path):
    rows = [
        ("a", "x", b"1"), ("a", "x", b"1"), ("a", None, None), ("b", "", b""),
        (None, "n", b"2"), ("", "e", b"3"), ("é\U0001f600", "y", b"\x00\xff"), ("long", "z", b"v" * 3_000_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    save(df, path)
    found = load(spark, path)
    assert found.schema == df.schema
    assert rows_of(found) == rows_of(df)
    for key in ("a", "", "é\U0001f600", "long", "no such key"):
        assert rows_of(load(spark, path, key=key)) == rows_of(df.where(F.col("key") == key))


def test_files_out_of_range_are_not_opened(spark, path):
    save(spark.range(1000).select(F.format_string("%04d", "id").alias("key")).repartitionByRange(4, "key"), path)
    segments = keyed.Folder(path).segments()
    assert len(segments) > 1 and sum(s.rows for s in segments) == 1000
    parts = keyed.KeyedReader(keyed.Folder(path), "0500").partitions()
    assert len(parts) == 1
    assert load(spark, path, key="0500").count() == 1


def test_large_files_are_read_by_blocks(spark, path, monkeypatch):
    monkeypatch.setattr(keyed, "SPLIT_BYTES", 1 << 10)
    monkeypatch.setattr(keyed, "BLOCK_BYTES", 1 << 12)
    keyed.register(spark)
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), "id").coalesce(1)
    save(df, path)
    (segment,) = keyed.Folder(path).segments()
    parts = keyed.KeyedReader(keyed.Folder(path), None).partitions()
    assert segment.blocks > 10 and len(parts) == segment.blocks
    assert [p.first for p in parts[1:]] == [p.end for p in parts[:-1]] and parts[-1].end == segment.blocks
    assert rows_of(load(spark, path)) == rows_of(df)


def test_cut_keeps_every_row(monkeypatch):
    monkeypatch.setattr(keyed, "BLOCK_BYTES", 100)
    batch = pa.RecordBatch.from_pydict({"key": ["x" * n for n in range(60)]})
    blocks = list(keyed.cut(batch))
    assert len(blocks) > 5
    assert pa.Table.from_batches(blocks).to_pydict() == batch.to_pydict()


def test_append_overwrite_and_what_is_left(spark, path):
    one, two = (spark.createDataFrame([(k, "f", b"v")], SCHEMA) for k in "ab")
    save(one, path)
    save(two, path)
    assert rows_of(load(spark, path)) == rows_of(one.unionAll(two))
    save(two, path, "overwrite")
    assert rows_of(load(spark, path)) == rows_of(two)
    assert keyed.remove_superseded(path) == 2
    assert len(files_of(path)) == 1
    assert rows_of(load(spark, path)) == rows_of(two)


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_a_write_that_fails_changes_nothing(spark, path, mode):
    before = spark.createDataFrame([("a", "f", b"v")], SCHEMA)
    save(before, path)
    broken = spark.range(0, 400, 1, 4).select(
        F.col("id").cast("string").alias("key"),
        F.lit("f").alias("field"),
        F.when(F.col("id") == 399, F.raise_error(F.lit("stop")).cast("binary"))
        .otherwise(F.lit(b"v")).alias("value"),
    )
    with pytest.raises(Exception, match="stop"):
        save(broken, path, mode)
    assert rows_of(load(spark, path)) == rows_of(before)
    # Tasks killed before they could report leave files that nobody reads.
    keyed.remove_superseded(path)
    assert len(files_of(path)) == 1
    assert rows_of(load(spark, path)) == rows_of(before)


def test_a_commit_that_stops_before_its_last_step(spark, path, monkeypatch):
    folder = keyed.Folder(path)
    before = spark.createDataFrame([("a", "f", b"v")], SCHEMA)
    save(before, path)
    writer = keyed.KeyedWriter(folder, before.schema, overwrite=True)
    batch = pa.RecordBatch.from_pydict({"key": ["z"], "field": ["f"], "value": [b"v"]})
    message = writer.write(iter([batch]))
    assert rows_of(load(spark, path)) == rows_of(before)
    # The same task once more: one of its files counts, the other is left for the sweep.
    writer.commit([writer.write(iter([batch])), writer.write(iter([]))])
    assert [r["key"] for r in load(spark, path).collect()] == ["z"]
    writer.abort([message, None])
    assert keyed.remove_superseded(path) == 1


def test_empty_and_wrong_tables(spark, path, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    save(empty, path)
    assert load(spark, path).schema == empty.schema
    assert rows_of(load(spark, path)) == [] and rows_of(load(spark, path, key="a")) == []
    with pytest.raises(Exception, match="no keyed rows"):
        load(spark, f"{tmp_path}/nothing").collect()
    with pytest.raises(Exception, match="a column named key"):
        save(spark.range(3), f"{tmp_path}/other")
    with pytest.raises(Exception, match="rows there have the columns"):
        save(spark.range(3).select(F.col("id").cast("string").alias("key")), path)


def test_blobs_and_their_lines(spark, tmp_path):
    by = ["motype", "sd"]
    blobs = spark.createDataFrame(
        [("m", 1, 0, "h|i\r\nh|i\r\na|\r\n"), ("m", 1, 1, "h|i\r\n"), (None, 2, 0, None), ("m", 3, 0, "h|i\r\n\r\n")],
        "motype string, sd int, part bigint, text string",
    )
    save_blobs(blobs, f"{tmp_path}/blobs", by)
    found = read_blobs(spark, f"{tmp_path}/blobs")
    assert rows_of(found.drop("key")) == rows_of(blobs)
    assert [r["text"] for r in read_blobs(spark, f"{tmp_path}/blobs", "m:1:0").collect()] == ["h|i\r\nh|i\r\na|\r\n"]
    lines = rows_of(blob_lines(found, by))
    assert lines == [("m", 1, 0, 1, "h|i"), ("m", 1, 0, 2, "a|"), ("m", 3, 0, 1, "")]
