"""Key/value lookups."""

from __future__ import annotations

import pytest

from slicecheck.operators import lookup


@pytest.fixture(scope="module")
def store(spark):
    hashes = spark.createDataFrame(
        [
            ("MOTYPE:MOTYPEID:SEQUENCE", "m", "7"),
            ("MOTYPE:MOTYPEID:SEQUENCE", "n", "8"),
            ("ALLMODELMAPPING", "m", "Cell"),
            ("ALLINDICATORID2SEQ:CONF", "a", "12"),
            ("OBJ:7:1", "MO", "100"),
            ("OBJ:7:1", "NAME", "one"),
            ("OBJ:7:2", "MO", "NULL"),
            ("OBJ:7:2", "NAME", "two"),
            ("OBJ:7:3", "NAME", "three"),
            ("OBJ:7:4", "MO", "100"),
            ("OBJ:7:4", "NAME", "four"),
            ("OBJ:7:5", "MO", "500"),
            ("OBJ:8:1", "MO", "1"),
        ],
        "key string, field string, value string",
    )
    texts = spark.createDataFrame(
        [
            ("MOTYPE:OBJ:LIST:m", "L1,L0,L2,"),
            ("L1", "4,2,3"),
            ("L2", "1,5,5,9"),
            ("MOTYPE:CONFIG:m", "mo,i1,,"),
        ],
        "key string, value string",
    )
    models = spark.createDataFrame([("m",), ("n",)], "motype string")
    return models, hashes, texts


def test_records_of_a_model(store):
    rows = {tuple(r) for r in lookup.model_objects(*store).collect()}
    # Object 1 comes after object 4 in list order, so it is the record of entity 100.
    assert rows == {
        ("m", "100", "MO", "100"),
        ("m", "100", "NAME", "one"),
        ("m", "500", "MO", "500"),
    }


def test_mappings(store):
    models, hashes, texts = store
    names = {tuple(r) for r in lookup.with_model_name(models, hashes).collect()}
    assert names == {("m", "Cell"), ("n", None)}
    assert [tuple(r) for r in lookup.indicator_columns(hashes).collect()] == [("a", "I12")]
    columns = {tuple(r) for r in lookup.model_columns(models, texts).collect()}
    assert columns == {("m", 0, "mo"), ("m", 1, "i1"), ("n", None, None)}
