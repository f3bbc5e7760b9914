"""Text functions and name rules."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from slicecheck.functions import text
from slicecheck.functions.models import LOGICAL_MODEL_IDS
from slicecheck.functions.names import cell_type, kpi_columns, table_name
from slicecheck.operators.members import set_members, set_nonmembers
from slicecheck.sinks.packed import exported_columns


@pytest.mark.parametrize(
    ("given", "items"),
    [
        ("a,b,,", ["a", "b"]),
        (",", []),
        (",,,", []),
        ("", [""]),
        (None, None),
        ("a, b", ["a", " b"]),
        (",a,,b", ["", "a", "", "b"]),
    ],
)
def test_split_list(spark, given, items):
    df = spark.createDataFrame([(given,)], "s string")
    assert df.select(text.split_list(F.col("s"))).first()[0] == items


def test_bracket_list(spark):
    df = spark.createDataFrame([(["i1", "i2"],), ([],)], "a array<string>")
    assert [r[0] for r in df.select(text.bracket_list(F.col("a"))).collect()] == ["[i1, i2]", "[]"]


def test_times(spark):
    df = spark.createDataFrame([(datetime(2019, 9, 26, 7, 5, 3),)], "t timestamp_ntz")
    row = df.select(text.stamp_long(F.col("t")), text.day_int(F.col("t"))).first()
    assert tuple(row) == (20190926070503, 20190926)


def test_same_text_ignores_case_and_is_never_null(spark):
    df = spark.createDataFrame([("NULL",), ("null",), ("x",), (None,)], "s string")
    found = [r[0] for r in df.select(text.same_text(F.col("s"), "Null")).collect()]
    assert found == [True, True, False, False]


def test_kpi_columns():
    names = ["MO", "i1", "I2", "i3a", "i", "i44", "isonsite", "k1", "mo", "xi5"]
    assert kpi_columns(names) == ["i1", "i44"]


def test_table_name_lowers_the_period_only():
    assert table_name("AbC", "H") == "t_AbC_h"


@pytest.mark.parametrize(
    ("name", "kind"),
    [
        ("mo", "string"),
        ("Mo", "string"),
        ("NAME", "string"),
        ("name", "string"),
        ("r12", "int"),
        ("rbh", "int"),
        ("n745", "string"),
        ("names", "string"),
        ("a1", "drop"),
        ("abh", "drop"),
        ("A1", None),
        ("sd", "int"),
        ("ST", "int"),
        ("sdt", "bigint"),
        ("isonsite", "string"),
        ("IsOnSite", "string"),
        ("isonsites", "double"),
        ("i1", "double"),
        ("kpi", "double"),
        ("dbh1", "double"),
        ("xwh", "double"),
        ("mh", "double"),
        ("other", None),
        ("R1", None),
    ],
)
def test_cell_type(name, kind):
    assert cell_type(name) == kind


def test_attributes_are_not_exported():
    assert exported_columns(["mo", "a1", "other", "A1"]) == ["mo", "other", "A1"]


def test_model_set(spark):
    assert len(LOGICAL_MODEL_IDS) == len(set(LOGICAL_MODEL_IDS)) == 105
    ids = [LOGICAL_MODEL_IDS[0], LOGICAL_MODEL_IDS[-1], "0" * 32, None]
    df = spark.createDataFrame([(i,) for i in ids], "motype string")
    assert set_members(df).count() == 2
    assert {r[0] for r in set_nonmembers(df).collect()} == {"0" * 32, None}
