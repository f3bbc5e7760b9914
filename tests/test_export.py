"""Packed text and batches."""

from __future__ import annotations

import gzip
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from slicecheck.operators.batches import key_batches, number_rows
from slicecheck.settings import SLICE
from slicecheck.sinks import packed
from slicecheck.settings import ensure_checkpoint_dir
from slicecheck.sinks.store import export_blobs, put_blobs

SF_DIR = "/root/testdata/sf0.001"


def whole_text(folder: Path) -> str:
    files = sorted(folder.glob("part-*"))
    return b"".join(gzip.decompress(f.read_bytes()) for f in files).decode()


def slice_folder(path: Path, row) -> Path:
    return path.joinpath(*[f"{c}={row[c]}" for c in SLICE])


def test_every_class_of_cell(spark):
    columns = ["mo", "NAME", "r1", "n5", "a1", "sd", "st", "sdt", "isonsite", "i1", "k1", "xbh", "z"]
    schema = (
        "mo string, NAME string, r1 int, n5 string, a1 string, sd int, st int, sdt bigint, "
        "isonsite string, i1 double, k1 double, xbh double, z string"
    )
    full = ("7", "n", 1, "s", "drop", 20240101, 0, 20240101000000, "y", 1e10, 0.5, 2.0, "lost")
    df = spark.createDataFrame([full, (None,) * 13], schema)
    assert packed.heading(columns) == "mo|NAME|r1|n5|sd|st|sdt|isonsite|i1|k1|xbh|z"
    lines = [r[0] for r in df.select(packed.packed_line(columns)).collect()]
    assert lines == ["7|n|1|s|20240101|0|20240101000000|y|1.0E10|0.5|2.0|", "|" * 11]


def test_written_slices_read_back(spark, tmp_path):
    rows = fx.export_rows(spark, SF_DIR)
    path = tmp_path / "packed"
    packed.write_packed(rows, fx.EXPORT_COLUMNS, str(path))
    expected = {}
    for r in packed.packed_lines(rows, fx.EXPORT_COLUMNS).collect():
        expected.setdefault(tuple(r[c] for c in SLICE), []).append(r)
    assert len(list(path.rglob("part-*"))) == len(expected)  # small slices: one file each
    for of_slice in expected.values():
        text = whole_text(slice_folder(path, of_slice[0]))
        ordered = sorted(of_slice, key=lambda r: (r["line_no"], r["_order"] or 0))
        assert text == "".join(r["line"] + "\r\n" for r in ordered)
    back = packed.read_packed(spark, str(path), fx.EXPORT_COLUMNS)
    assert back.count() == rows.count() and set(SLICE) < set(back.columns)


def test_a_large_slice_is_split_over_files(spark, tmp_path):
    """Even if all its rows are copies of one."""
    rows = spark.range(0, 400_000, 1, 16).select(
        F.lit("m").alias("motype"),
        F.lit("h").alias("period"),
        F.lit(20240101).alias("sd"),
        F.when(F.col("id") % 1000 == 0, 1).otherwise(0).alias("st"),
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("mo"),
        F.repeat(F.lit("text "), 9).alias("name"),
    )
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        packed.write_packed(rows, ["mo", "name"], str(tmp_path / "packed"))
    finally:
        for key in small:
            spark.conf.unset(key)
    folder = tmp_path / "packed" / "motype=m" / "period=h" / "sd=20240101"
    files = sorted((folder / "st=0").glob("part-*"))
    assert len(files) > 3
    for st, n in ((0, 399_600), (1, 400)):
        lines = whole_text(folder / f"st={st}").split("\r\n")
        assert lines[0] == "mo|name" and lines[-1] == ""
        assert len(lines) == n + 2 and lines.count("mo|name") == 1
    sizes = [len(gzip.decompress(f.read_bytes())) for f in files]
    assert max(sizes) < sum(sizes) / 3


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_blobs_hold_every_copy_of_a_row(spark, size):
    numbers = [5, 5, 5, 5, 5, 5, 5, 2, 9, 1, 1]
    df = spark.createDataFrame([("a", n) for n in numbers] + [("b", 4)], "s string, mo bigint")
    blobs = packed.packed_blobs(df, ["mo"], ["s"], size).orderBy("s", "part").collect()
    found = {"a": [], "b": []}
    for blob in blobs:
        head, *lines, end = blob["text"].split("\r\n")
        assert (head, end) == ("mo", "") and 0 < len(lines) <= size
        assert blob["part"] == len(found[blob["s"]]) // size
        found[blob["s"]] += [int(line) for line in lines]
    assert found == {"a": sorted(numbers), "b": [4]}


def test_blobs_reach_a_store(spark, tmp_path):
    folder = str(tmp_path)

    class Files:
        def set(self, key, value):
            Path(folder, key).write_bytes(value)

        def close(self):
            pass

    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4)], "s string, mo bigint")
    put_blobs(packed.packed_blobs(df, ["mo"], ["s"], 2), Files, ["s"])
    found = {f.name: zlib.decompress(f.read_bytes()).decode() for f in tmp_path.iterdir()}
    assert found == {
        "a:0": "mo\r\n1\r\n2\r\n",
        "a:1": "mo\r\n3\r\n",
        "b:0": "mo\r\n4\r\n",
    }


def test_read_back_keeps_ids_and_rows_like_the_heading(spark, tmp_path):
    rows = [("00123", "h", 20240101, 0, 1, "a"), ("00123", "h", 20240101, 0, None, "name")]
    rows += [("7", "h", 20240102, 5, 2, None)] * 2
    df = spark.createDataFrame(rows, "motype string, period string, sd int, st int, mo long, name string")
    # The name of the first column alone, so that a cell can look like the heading.
    packed.write_packed(df, ["name"], str(tmp_path / "packed"))
    back = packed.read_packed(spark, str(tmp_path / "packed"), ["name"])
    found = sorted(tuple(r[c] for c in ("motype", "sd", "st", "value")) for r in back.collect())
    assert found == [
        ("00123", 20240101, 0, "a"), ("00123", 20240101, 0, "name"),
        ("7", 20240102, 5, ""), ("7", 20240102, 5, ""),
    ]


def test_an_export_leaves_nothing_in_between(spark, tmp_path):
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    target, held = str(tmp_path), set(folder.iterdir())

    class Files:
        def set(self, key, value):
            Path(target, key).write_bytes(value)

        def close(self):
            pass

    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4)], "s string, mo bigint")
    export_blobs(df, ["mo"], Files, ["s"], 2)
    assert sorted(f.name for f in tmp_path.iterdir()) == ["a:0", "b:0"]
    assert set(folder.iterdir()) == held


def test_batches_of_one_large_slice(spark):
    """A slice with most of the keys is ranked in several ranges and counts on through them."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(100).alias("s"),
        (F.col("id") * 7919 % 20_011).alias("mo"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = key_batches(df.unionAll(df), ["s"], size=1000).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = {}
    for r in df.collect():
        expected.setdefault(r["s"], []).append(r["mo"])
    found = {(r["s"], r["mo"]): r["batch"] for r in rows}
    assert len(rows) == len(found) == 20_000
    for s, numbers in expected.items():
        for place, mo in enumerate(sorted(numbers, reverse=True)):
            assert found[s, mo] == place // 1000


def test_positions_in_null_slices(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), (1, 2)], "s int, mo bigint")
    rows = {(r["s"], r["mo"]): r["pos"] for r in number_rows(df, ["s"], ["mo"]).collect()}
    assert rows == {(None, 1): 0, (None, 3): 1, (1, 2): 0}
