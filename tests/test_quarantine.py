"""Faults of single tables fail their own tasks only."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from slicecheck.operators.casting import typed_projection
from slicecheck.plans.batch import reconcile_batch, reconcile_tables
from slicecheck.sources.quarantine import fault_rows, inspect, read_copy
from slicecheck.sources.tables import facts_of
from slicecheck.sources.tasks import TASK_SCHEMA

ROWS = [(20240101, 0, 1, 1.0), (20240101, 0, 2, 2.0), (20240101, 1, 3, 3.0), (20240101, 1, 4, 4.0)]


@pytest.fixture(scope="module")
def sound(spark):
    return spark.createDataFrame(ROWS, "sd int, st int, mo bigint, i1 double").withColumn("i2", F.col("i1"))


def judged(spark, new, old, lists=None):
    """(model, time) to status, and the faults."""
    rows = [
        (10 * n + st, model, "h", 20240101, st, lists, None)
        for n, (model, _) in enumerate(sorted({*new, *old, ("gone", "h")}))
        for st in (0, 1)
    ]
    tasks = spark.createDataFrame(rows, TASK_SCHEMA)
    batch, faults = reconcile_tables(tasks, inspect(new, "new"), inspect(old, "old"))
    found = {(r.motype, r.st): r.status for r in batch.results.collect()}
    return found, {(f.motype, f.side, f.place, f.reason) for f in faults.collect()}


ODD = {
    "no key": (lambda df: df.drop("mo"), "mo", "no column"),
    "no day": (lambda df: df.drop("sd"), "sd", "no column"),
    "two keys": (lambda df: df.toDF("sd", "st", "mo", "i1", "MO"), "mo", "ambiguous column"),
    "date key": (lambda df: df.withColumn("mo", F.current_date()), "mo", "no numbers"),
    "date day": (lambda df: df.withColumn("sd", F.current_date()), "sd", "no numbers"),
    "struct time": (lambda df: df.withColumn("st", F.struct("st")), "st", "no numbers"),
    "text day": (lambda df: df.withColumn("sd", F.when(F.col("mo") == 1, "x").otherwise(F.col("sd").cast("string"))), "sd, st", "no slot"),
    "half time": (lambda df: df.withColumn("st", F.when(F.col("mo") == 1, 0.5).otherwise(F.col("st"))), "sd, st", "no slot"),
    "wide day": (lambda df: df.withColumn("sd", F.when(F.col("mo") == 1, 1 << 40).otherwise(F.col("sd"))), "sd, st", "no slot"),
}


@pytest.mark.parametrize("side", ["new", "old"])
def test_odd_tables_fail_alone(spark, sound, side):
    good = {("sound", "h"): sound}
    odd = {(name, "h"): make(sound) for name, (make, _, _) in ODD.items()}
    same = {model: sound for model in odd}
    copies = (good | odd, good | same) if side == "new" else (good | same, good | odd)
    found, faults = judged(spark, *copies)
    assert {m for (m, _), status in found.items() if status == 1} == {"sound"}
    assert {status for (m, _), status in found.items() if m != "sound"} == {2}
    assert faults == {(name, side, place, reason) for name, (_, place, reason) in ODD.items()}


def test_kpis_without_numbers_fail_what_checks_them(spark, sound):
    good = {("m", "h"): sound}
    for odd in (F.current_date(), F.lit(True), F.array(F.lit(1.0))):
        bad = {("m", "h"): sound.withColumn("i1", odd)}
        for copies in ((good, bad), (bad, good)):
            assert judged(spark, *copies)[0]["m", 0] == 2
            assert judged(spark, *copies, lists="i2")[0]["m", 0] == 1
            assert judged(spark, *copies, lists="i2,I1")[0]["m", 0] == 2


def test_nan_and_small_fractions_are_no_keys(spark, sound):
    for odd in (float("nan"), float("inf"), 1 + 1e-12, 1.7):
        key = F.when(F.col("mo") == 1, F.lit(odd)).otherwise(F.col("mo").cast("double"))
        table = {("m", "h"): sound.withColumn("mo", key)}
        found, faults = judged(spark, {("m", "h"): sound}, table)
        assert (found["m", 0], found["m", 1], faults) == (2, 1, set())
    facts = facts_of(spark, table, {("m", "h"): ["i1"]})
    assert facts.where("_bad_key = 1").count() == 1
    keys = [r.mo for r in typed_projection(table["m", "h"], ["i1"]).collect()]
    assert sorted(k for k in keys if k) == [2, 3, 4] and keys.count(None) == 1


def test_keys_of_other_models_are_not_rounded(spark, sound):
    big = (1 << 60) + 1
    large = spark.createDataFrame([(20240101, 0, big, 1.0)], "sd int, st int, mo bigint, i1 double")
    floats = sound.withColumn("mo", F.col("mo").cast("double"))
    facts = facts_of(spark, {("a", "h"): large, ("b", "h"): floats}, {("a", "h"): ["i1"], ("b", "h"): ["i1"]})
    assert facts.where("motype = 'a'").first().mo == big


def test_tables_of_the_catalog(spark, sound):
    spark.sql("CREATE DATABASE IF NOT EXISTS quarantine_db")
    sound.write.mode("overwrite").saveAsTable("quarantine_db.t_M_h")
    sound.drop("mo").write.mode("overwrite").saveAsTable("quarantine_db.t_n_h")
    spark.range(1).write.mode("overwrite").saveAsTable("quarantine_db.t_base")
    spark.sql("CREATE OR REPLACE VIEW quarantine_db.t_v_h AS SELECT id AS mo FROM quarantine_db.t_base")
    spark.sql("DROP TABLE quarantine_db.t_base")
    copy = read_copy(spark, [("M", "H"), ("n", "h"), ("v", "h"), ("none", "h")], "new", "quarantine_db")
    assert set(copy.tables) == {("M", "h")} and copy.listed == {("M", "h"): ["i1", "i2"]}
    assert {(f[0], f[4]) for f in copy.faults} == {("n", "no column"), ("v", "unreadable")}
    assert read_copy(spark, [("M", "h")], "old", "no_such_db").tables == {}
    assert fault_rows(spark, [copy]).count() == 2


def test_without_faults_nothing_is_read_twice(spark, sound):
    new = inspect({("m", "h"): sound}, "new")
    assert fault_rows(spark, [new, new]).collect() == []
    assert "Scan" not in fault_rows(spark, [new])._jdf.queryExecution().optimizedPlan().toString().replace("ExistingRDD", "")


def test_batches_without_catalog_take_models_that_failed(spark, sound):
    facts = sound.select(F.lit("m").alias("motype"), F.lit("h").alias("period"), "*")
    tasks = spark.createDataFrame([(1, "m", "h", 20240101, 0, None, None)], TASK_SCHEMA)
    failed = spark.createDataFrame([("m", "h")], "motype string, period string")
    assert reconcile_batch(tasks, facts, facts, ["i1"]).results.first().status == 1
    assert reconcile_batch(tasks, facts, facts, ["i1"], failed=failed).results.first().status == 2
