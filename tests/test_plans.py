"""Shape of the plans: what would not scale must not appear in them."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.catalogue import QUERIES
from slicecheck.operators import compare
from slicecheck.operators.batches import number_rows
from slicecheck.plans.summary import summarize
from slicecheck.settings import ensure_checkpoint_dir

SF_DIR = "/root/testdata/sf0.001"
UNBOUNDED = ["CartesianProduct", "BroadcastNestedLoopJoin"]
PYTHON = ["ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not [node for node in UNBOUNDED + PYTHON if node in plan]


def test_rows_are_combined_before_the_only_shuffle_of_facts(spark, tmp_path):
    facts = spark.range(1000).select(F.col("id").alias("mo"), F.lit(1.0).alias("i1"), F.lit(2.0).alias("i2"))
    facts.write.parquet(str(tmp_path / "facts"))
    side = spark.read.parquet(str(tmp_path / "facts"))
    cmp = compare.compare_wide(side, side, ["mo"], ["i1"])
    plan = plan_of(summarize(cmp, [], 1))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan.split("Exchange hashpartitioning")[1]
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas == ["mo:bigint,i1:double"] * 2  # i2 is not read


def test_wide_tables(spark):
    """Hundreds of KPIs still make one plan."""
    kpis = [f"i{n}" for n in range(256)]
    new = spark.range(500).select(F.col("id").alias("mo"), *[F.lit(float(n)).alias(k) for n, k in enumerate(kpis)])
    old = new.withColumn("i255", F.when(F.col("mo") < 10, 0.0).otherwise(F.col("i255")))
    cmp = compare.compare_wide(new, old, ["mo"], kpis)
    assert tuple(summarize(cmp, [], 256).first())[:3] == (128_000, 127_990, 10)
    assert {tuple(r["bad"]) for r in cmp.where("n_bad > 0").collect()} == {("i255",)}


def test_ranks_of_large_groups_come_from_pieces(spark):
    chance = random.Random(1)
    rows = [(g, None if i % 97 == 0 else chance.randint(0, 400), i, chance.randint(1, 3)) for g, n in (("a", 3000), (None, 500), ("b", 20)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, x int, y long, n long").repartition(5)
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    for order, key in (
        (["x", "y"], lambda r: (r[1] is not None, r[1], r[2])),
        (["-x", "y"], lambda r: (r[1] is None, -(r[1] or 0), r[2])),
    ):
        expected, weighted = {}, {}
        for g in ("a", None, "b"):
            start = 0
            for place, r in enumerate(sorted([r for r in rows if r[0] == g], key=key)):
                expected[g, r[2]], weighted[g, r[2]] = place, start
                start += r[3]
        held = set(folder.iterdir())
        found = number_rows(df, ["g"], order, piece_rows=100)
        assert {(r.g, r.y): r.pos for r in found.collect()} == expected
        # Bounds and counts only, never the rows.
        tables = [spark.read.parquet(str(p)) for p in set(folder.iterdir()) - held]
        assert tables and all(t.count() < 100 for t in tables)
        found = number_rows(df, ["g"], order, copies="n", piece_rows=100)
        assert {(r.g, r.y): r.pos for r in found.collect()} == weighted
        found = number_rows(df, ["g"], order)
        assert {(r.g, r.y): r.pos for r in found.collect()} == expected


def test_pieces_are_of_the_stated_size(spark):
    df = spark.range(20_000).selectExpr("IF(id % 10 = 0, 'b', 'a') AS g", "id AS x")
    found = number_rows(df, ["g"], ["x"], piece_rows=2000)
    window = next(n for n in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window" in n)
    piece = re.search(r"_piece#\d+", window)[0]
    assert piece and found.count() == 20_000
    assert found.groupBy("g").agg(F.max("pos")).count() == 2
