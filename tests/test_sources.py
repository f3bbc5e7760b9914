"""Catalog tables, pruning of scans, and options of the database reader."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from slicecheck.plans.batch import asked_for, check_plans, reconcile_batch, route
from slicecheck.settings import written
from slicecheck.sources import tables
from slicecheck.sources.old_store import jdbc_options, old_tables
from slicecheck.sources.strides import read_strides, stride_bounds, stride_predicates
from slicecheck.sources.tasks import TASK_SCHEMA, read_models, read_tasks


@pytest.fixture(scope="module")
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS kpi")
    base = spark.range(1, 101).select(
        F.col("id").cast("string").alias("MO"),
        F.lit("x").alias("name"),
        (F.col("id") * 1.0).alias("i1"),
        (F.col("id") * 2.0).alias("i2"),
        F.lit(1.0).alias("k1"),
        (F.col("id") % 2).cast("int").alias("st"),
        F.lit(20240101).alias("sd"),
    )
    base.write.partitionBy("sd").saveAsTable("kpi.t_m_h")
    base.drop("i2").withColumn("i3", F.lit(5)).write.partitionBy("sd").saveAsTable("kpi.t_n_h")
    yield "kpi"
    spark.sql("DROP DATABASE kpi CASCADE")


def test_catalog(spark, database):
    assert tables.table_kpis(spark, "m", "H", database) == ["i1", "i2"]
    assert tables.table_kpis(spark, "none", "h", database) is None
    tables.use_database(spark, database)
    assert tables.kpi_table(spark, "m", "h").count() == 100
    tables.use_database(spark, "default")


def test_slice_scan_reaches_the_files(spark, database):
    scan = tables.slice_scan(tables.kpi_table(spark, "m", "h", database), 20240101, 1, ["i2"])
    assert scan.columns == ["mo", "i2"] and scan.count() == 50
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sd" in plan
    assert "PushedFilters: [IsNotNull(st), EqualTo(st,1)]" in plan
    assert "ReadSchema: struct<MO:string,i2:double,st:int>" in plan


def test_models_with_tables_of_their_own(spark, database):
    catalog = tables.model_catalog(spark, [("m", "h"), ("n", "H"), ("none", "h")], database)
    assert catalog == {("m", "h"): ["i1", "i2"], ("n", "h"): ["i1", "i3"]}
    facts = tables.load_models(spark, catalog, database)
    assert facts.columns == ["motype", "period", "sd", "st", "mo", "_bad_key", "v1", "v2"]
    assert facts.count() == 200
    asked = [("m", None), ("n", None), ("none", None)]
    tasks = spark.createDataFrame(
        [(i, m, "h", 20240101, 1, kpis, None) for i, (m, kpis) in enumerate(asked)], TASK_SCHEMA
    )
    off = facts.withColumn("v2", F.when(F.col("motype") == "n", 9.0).otherwise(F.col("v2")))
    batch = reconcile_batch(tasks, facts, off, ["v1", "v2"], catalog)
    found = {r["motype"]: (r["all_n"], r["error_n"], r["status"]) for r in batch.results.collect()}
    assert found == {"m": (100, 0, 1), "n": (100, 50, -1), "none": (0, 0, 2)}
    assert {(r["motype"], r["fields"]) for r in batch.details.collect()} == {("n", "[i3]")}


def test_old_side_may_lack_tables_and_kpis(spark, database):
    catalog = {("m", "h"): ["i1", "i2", "i9"], ("none", "h"): ["i1"]}
    facts = tables.load_models(spark, catalog, database)
    assert facts.count() == 100 and facts.where("v3 is not null").isEmpty()


def test_tasks_prune_days(spark, database):
    days = spark.range(300).select(
        F.col("id").alias("mo"),
        (F.col("id") * 1.0).alias("i1"),
        F.lit(0).alias("st"),
        (20240101 + F.col("id") % 5).cast("int").alias("sd"),
    )
    days.write.partitionBy("sd").saveAsTable("kpi.t_d_h")
    facts = tables.load_models(spark, {("d", "h"): ["i1"]}, database)
    asked = [(day, "d", "h", day, 0, None, None) for day in (20240102, 20240104)]
    groups = written(check_plans(spark.createDataFrame(asked, TASK_SCHEMA), ["v1"]))
    routed = route([facts, facts], groups, asked_for(groups), ["v1"])[0]
    assert routed.count() == 120
    plan = routed._jdf.queryExecution().executedPlan().toString()
    # The range of days prunes when the query is planned, the days of the tasks when it runs.
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "20240102" in filters and "dynamicpruning" in filters


def test_no_table_at_all(spark, database):
    assert tables.model_catalog(spark, [("none", "h")], database) == {}
    assert tables.load_models(spark, {("none", "h"): ["i1"]}, database).isEmpty()
    assert tables.load_models(spark, {}, database).isEmpty()


def test_views_do_not_clash(spark):
    names = [tables.named_view(spark.range(n), "side") for n in (1, 2)]
    assert [spark.table(n).count() for n in names] == [1, 2]


def test_task_and_model_lists(spark, tmp_path):
    tasks = spark.createDataFrame([(1, "m", "h", 20240101, 0, None, "1,2")], TASK_SCHEMA)
    tasks.write.parquet(str(tmp_path / "tasks"))
    assert read_tasks(spark, str(tmp_path / "tasks")).collect() == tasks.collect()
    tasks.select("motype").write.json(str(tmp_path / "models"))
    assert read_models(spark, str(tmp_path / "models"), "json").first()[0] == "m"


def test_old_tables_are_read_one_per_model(spark):
    asked = []

    def read(options):
        asked.append(options["dbtable"])
        return spark.range(6).selectExpr("id AS MO", "CAST(id AS STRING) AS I1", "CAST(20240100 + id AS INT) AS SD", "0 AS ST")

    def options(name):
        return jdbc_options("jdbc:x", name, 1, 1000, 16)

    found = old_tables(spark, [("m", "H"), ("n", "h")], options, 20240102, 20240103, read)
    assert asked == ["t_m_h", "t_n_h"] and set(found) == {("m", "h"), ("n", "h")}
    assert tables.catalog_of(found) == {("m", "h"): ["i1"], ("n", "h"): ["i1"]}
    facts = tables.facts_of(spark, found, {("m", "h"): ["i1", "i9"]}).drop("_bad_key")
    assert sorted(tuple(r) for r in facts.collect()) == [
        ("m", "h", 20240102, 0, 2, "2", None), ("m", "h", 20240103, 0, 3, "3", None),
    ]


def test_models_are_those_of_the_tasks(spark):
    rows = [(1, "m", "H", 1, 0, None, None), (2, "m", "h", 2, 0, None, None), (3, None, "h", 2, 0, None, None)]
    assert tables.task_models(spark.createDataFrame(rows, TASK_SCHEMA)) == [("m", "h")]


def test_database_reads_are_parallel():
    options = jdbc_options("jdbc:x", "kpi", 1, 1000, 16, driver="x.Driver")
    assert options["partitionColumn"] == "mo" and options["numPartitions"] == "16"
    assert options["driver"] == "x.Driver" and options["fetchsize"] == "10000"


def _counts_of(df, predicates):
    seen = [df.where(p) for p in predicates]
    return [part.count() for part in seen], seen


def test_strides_hold_every_row_once_and_about_equally_many(spark):
    chance = random.Random(3)
    rows = [(7 if i % 3 == 0 else chance.randint(1, 20) ** 4, chance.randint(1, 40), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "mo long, sd int, i long")
    found = stride_predicates(df, 12)
    sizes, parts = _counts_of(df, found)
    assert sum(sizes) == 6000 and read_strides(spark, "", "t", found, read=df.where).distinct().count() == 6000
    assert max(sizes) <= 2 * 6000 / 12 and 10 <= len(found) <= 14
    # Without a second column the hot key is one range.
    sizes, _ = _counts_of(df, stride_predicates(df, 12, split=None))
    assert sum(sizes) == 6000 and max(sizes) == sum(mo == 7 for mo, _, _ in rows)


def test_strides_of_awkward_keys(spark):
    schema = "mo double, sd int"
    nan, inf = float("nan"), float("inf")
    rows = [(None, None), (None, 1), (5.0, None), (5.5, 1), (5.0, 2), (5.0, 3), (5.0, 4), (6.0, 1), (nan, 1), (inf, 1), (-1e18, 1), (4.25, 9)]
    df = spark.createDataFrame(rows, schema)
    for parts in (1, 2, 3, 8, 50):
        sizes, _ = _counts_of(df, stride_predicates(df, parts))
        assert sum(sizes) == len(rows), parts
    # Bounds from one table, rows of another.
    sizes, _ = _counts_of(df, stride_predicates(spark.range(100).selectExpr("id AS mo", "1 AS sd"), 8))
    assert sum(sizes) == len(rows)
    empty = df.limit(0)
    assert stride_predicates(empty, 8) == ["1 = 1"] and stride_bounds(empty, "mo", 8) == []
    same = spark.range(100).selectExpr("7L AS mo", "3 AS sd")
    sizes, _ = _counts_of(same, stride_predicates(same, 8))
    assert sum(sizes) == 100
