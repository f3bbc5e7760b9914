"""What an operator writes on its way is gone once its result is written elsewhere."""

from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from slicecheck.llm.queries import QUERIES
from slicecheck.settings import ensure_checkpoint_dir, passing_tables

SF_DIR = "/root/testdata/sf0.001"


def left(spark) -> set[str]:
    return {p.name for p in Path(ensure_checkpoint_dir(spark).removeprefix("file:")).iterdir()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_nothing_is_left_of_a_query(spark, tmp_path, name):
    before = left(spark)
    with passing_tables(spark):
        QUERIES[name](spark, SF_DIR).write.parquet(f"{tmp_path}/result")
    assert left(spark) == before
    assert not spark.read.parquet(f"{tmp_path}/result").isEmpty()


def test_nothing_is_left_of_the_pipeline(spark, tmp_path):
    before = left(spark)
    corpus_pipeline.save(spark, SF_DIR, f"{tmp_path}/result")
    assert left(spark) == before
    saved = spark.read.parquet(f"{tmp_path}/result")
    assert saved.count() > 0 and saved.where("NOT round_trip").isEmpty()
