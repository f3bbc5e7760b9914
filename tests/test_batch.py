"""Task plans: one batch with every kind of task, and its outputs on disk."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from slicecheck.plans import batch as plans
from slicecheck.plans import tasks as task_plans
from slicecheck.plans.batch import asked_for, check_plans, reconcile_batch, route, run_batch, runs_of
from slicecheck.settings import ensure_checkpoint_dir, written
from slicecheck.sinks.runs import Runs
from slicecheck.sources.tables import catalog_of, facts_of, value_columns
from slicecheck.sources.tasks import TASK_SCHEMA, pending_tasks

KPIS = ["i1", "i2"]
FACTS = "motype string, period string, sd int, st int, mo bigint, i1 double, i2 double"


def at(text="2024-02-01 03:04:05"):
    return F.lit(text).cast("timestamp")


def slot(st, *rows, motype="m"):
    return [(motype, "h", 20240101, st, *row) for row in rows]


def task(task_id, st, indicators=None, moentities=None, motype="m", period="h"):
    return (task_id, motype, period, 20240101, st, indicators, moentities)


@pytest.fixture(scope="module")
def sides(spark):
    same = [(1, 1.0, 1.0), (2, 1.0, 1.0), (3, 1.0, 1.0)]
    off = [(1, 1.0, 9.0), (2, 5.0, 9.0), (3, 1.0, 1.0)]
    new = [row for st in range(6) for row in slot(st, *same)]
    old = (
        slot(0, *same)
        + slot(1, *off)
        + slot(2, *same, (1, 1.0, 1.0))
        + slot(3, (8, 1.0, 1.0))
        + slot(5, *off)
    )
    new += slot(0, (1, 1.0, 1.0), motype="n")
    old += slot(0, (1, 1.0, 1.0), motype="n")
    return spark.createDataFrame(new, FACTS), spark.createDataFrame(old, FACTS)


def run(spark, sides, *tasks, **options):
    batch = reconcile_batch(spark.createDataFrame(list(tasks), TASK_SCHEMA), *sides, KPIS, **options)
    results = {(r["motype"], r["st"]): r for r in batch.results.collect()}
    details = {(r["st"], r["mo"]): r["fields"] for r in batch.details.collect()}
    return results, details


def test_all_slices_are_judged(spark, sides):
    results, details = run(spark, sides, *[task(st, st) for st in range(7)])
    assert {st: r["status"] for (_, st), r in results.items()} == {
        0: 1,
        1: -1,
        2: 2,  # a key is there twice
        3: 2,  # no key matches
        4: 2,  # the old side has no such slice
        5: -1,
        6: 2,  # no side has it
    }
    assert (results["m", 1]["all_n"], results["m", 1]["error_n"]) == (6, 3)
    assert details == {(s, m): f for s in (1, 5) for m, f in {1: "[i2]", 2: "[i1, i2]"}.items()}


@pytest.mark.parametrize(
    ("indicators", "counts", "fields"),
    [
        ("i2", (3, 2, -1), {1: "[i2]", 2: "[i2]"}),
        ("i2,i1", (6, 3, -1), {1: "[i2]", 2: "[i2, i1]"}),
        ("i1,i1,,", (6, 2, -1), {2: "[i1, i1]"}),
        ("mo, I1", (3, 1, -1), {2: "[ I1]"}),
        ("i1,i7", (6, 1, 2), {}),
        ("i1,,i2", (9, 3, 2), {}),
        ("", (3, 0, 2), {}),
        (",", (0, 0, -1), {}),
    ],
)
def test_kpi_lists(spark, sides, indicators, counts, fields):
    results, details = run(spark, sides, task(1, 1, indicators))
    row = results["m", 1]
    assert (row["all_n"], row["error_n"], row["status"]) == counts
    assert details == {(1, mo): text for mo, text in fields.items()}


def test_entity_lists(spark, sides):
    listed = [task(1, 1, None, "3, 1,x,99,"), task(2, 2, None, "2,3"), task(3, 5, None, ",")]
    results, details = run(spark, sides, *listed)
    assert (results["m", 1]["all_n"], results["m", 1]["error_n"]) == (4, 1)
    assert details == {(1, 1): "[i2]"}
    assert results["m", 2]["status"] == 1  # the key that is there twice is not listed
    assert results["m", 5]["status"] == 2  # nothing is listed


def test_details_of_slices_that_pass(spark, sides):
    options = {"threshold": 0.4}
    results, details = run(spark, sides, task(1, 1), task(2, 2), **options)
    assert results["m", 1]["status"] == 1 and details == {}
    _, details = run(spark, sides, task(1, 1), task(2, 2), always=True, **options)
    assert set(details) == {(1, 1), (1, 2)}


def test_first_task_of_a_slice_decides_and_all_get_its_result(spark, sides):
    tasks = spark.createDataFrame(
        [task(9, 1, "i2"), task(4, 1, "i1", period="H"), task(7, 0)], TASK_SCHEMA
    )
    batch = reconcile_batch(tasks, *sides, KPIS)
    rows = {r["task_id"]: r for r in task_plans.result_rows(batch.results, tasks, at()).collect()}
    assert {i: (r["status"], r["all_n"], r["error_n"]) for i, r in rows.items()} == {
        4: (-1, 3, 1),
        9: (-1, 3, 1),
        7: (1, 6, 0),
    }
    assert rows[4]["finish_time"] == 20240201030405
    groups = {r["st"]: r for r in task_plans.task_groups(tasks).collect()}
    assert (groups[1]["n_tasks"], groups[1]["first_task_id"]) == (2, 4)
    ids = {r["st"]: r["task_ids"] for r in task_plans.group_task_ids(tasks).collect()}
    assert ids == {1: [4, 9], 0: [7]}


def test_a_task_without_a_slot_fails(spark, sides):
    tasks = spark.createDataFrame([task(1, None), task(2, 0)], TASK_SCHEMA)
    batch = reconcile_batch(tasks, *sides, KPIS)
    rows = task_plans.result_rows(batch.results, tasks, at()).collect()
    assert {r["task_id"]: r["status"] for r in rows} == {1: 2, 2: 1}


def test_catalog_of_models(spark, sides):
    catalog = {("m", "h"): ["i1"]}
    asked = [task(1, 1), task(2, 5, "i1,i2"), task(3, 0, motype="n")]
    results, _ = run(spark, sides, *asked, catalog=catalog)
    assert (results["m", 1]["all_n"], results["m", 1]["status"]) == (3, -1)
    assert results["m", 5]["status"] == 2  # the model has no such KPI
    assert results["n", 0]["status"] == 2  # there is no such model


def test_junk_fails_its_own_slice_only(spark, sides):
    new, old = sides
    text = old.withColumn("i1", F.col("i1").cast("string")).withColumn(
        "i1", F.when((F.col("st") == 1) & (F.col("mo") == 3), "junk").otherwise(F.col("i1"))
    )
    results, _ = run(spark, (new, text), task(1, 1), task(2, 5), task(3, 0))
    assert [results["m", st]["status"] for st in (1, 5, 0)] == [2, -1, 1]
    results, _ = run(spark, (new, text), task(1, 1, "i2"))
    assert results["m", 1]["status"] == -1  # the KPI with junk is not checked


@pytest.fixture
def shuffled(spark, monkeypatch):
    """Slices are neither sent nor left to adaptive execution."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    monkeypatch.setattr(plans, "SENT_SLICES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for key, value in kept.items():
        spark.conf.set(key, value)


def test_joined_slices_give_the_same(spark, sides, request, monkeypatch):
    asked = [task(1, 1), task(2, 5, "i2", "1,2"), task(3, 6)]
    sent = run(spark, sides, *asked)
    request.getfixturevalue("shuffled")
    assert run(spark, sides, *asked) == sent
    monkeypatch.setattr(plans, "SALT_ROWS", 2)
    assert run(spark, sides, *asked) == sent


def test_no_task_gets_a_hot_slice(spark, shuffled, monkeypatch):
    rows = 20_000
    monkeypatch.setattr(plans, "SALT_ROWS", rows // 16)
    facts = spark.range(rows).selectExpr(
        "'m' AS motype", "'h' AS period", "20240101 AS sd", "CAST(IF(id % 10 < 9, 0, id % 100) AS INT) AS st",
        "id AS mo", "1.0D AS i1",
    )
    tasks = spark.createDataFrame([task(st, st) for st in range(100)], TASK_SCHEMA)
    groups = written(check_plans(tasks, ["i1"]))
    new, _ = route([facts, facts], groups, asked_for(groups), ["i1"])
    joined = new.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in joined) == rows
    # Of the slice with nine tenths of all rows no task has more than a third.
    assert max(r["count"] for r in joined) < rows / 3
    batch = reconcile_batch(tasks, facts, facts, ["i1"])
    found = {r["st"]: (r["matched"], r["status"]) for r in batch.results.collect()}
    assert found[0] == (rows * 9 // 10, 1) and found[9] == (200, 1) and found[10] == (0, 2)


def test_only_what_is_asked_for_is_read_and_shuffled(spark, tmp_path):
    columns = ", ".join(f"CAST(id AS DOUBLE) AS i{n}" for n in range(20))
    text = f"""SELECT 'm' AS motype, 'h' AS period, 20240101 AS sd, CAST(id % 50 AS INT) AS st,
               id AS mo, {columns} FROM range(1000)"""
    spark.sql(text).write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    kpis = [f"i{n}" for n in range(20)]
    tasks = spark.createDataFrame([task(1, 3, "i3"), task(2, 4, "i3,i7", "4,54")], TASK_SCHEMA)
    groups = written(check_plans(tasks, kpis))
    asked = asked_for(groups)
    assert (asked.first_day, asked.last_day, asked.places, asked.restricted) == (20240101, 20240101, [3, 7], True)
    new, _ = route([facts, facts], groups, asked, ["i3", "i7"])
    assert new.columns == ["slice_no", "mo", "i3", "i7"]
    assert new.count() == 20 + 2  # rows of two slices, one of them cut to its entities
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "i3" in plan and "i5" not in plan
    batch = reconcile_batch(tasks, facts, facts, kpis)
    assert {r["st"]: (r["all_n"], r["status"]) for r in batch.results.collect()} == {3: (20, 1), 4: (4, 1)}


def test_keys_that_are_no_numbers_fail_their_slice(spark, sides):
    new, old = sides
    text = old.withColumn("mo", F.when((F.col("st") == 0) & (F.col("mo") == 2), "a1").otherwise(F.col("mo").cast("string")))
    results, _ = run(spark, (new, text), task(1, 0), task(2, 5))
    assert [results["m", st]["status"] for st in (0, 5)] == [2, -1]
    row = results["m", 0]
    assert (row["matched"], row["only_new"], row["only_old"], row["null_keys"], row["bad_keys"]) == (2, 1, 0, 0, 1)
    fractions = old.withColumn("mo", F.col("mo") + 0.5)
    results, _ = run(spark, (new, fractions), task(1, 0))
    assert results["m", 0]["bad_keys"] == 3 and results["m", 0]["matched"] == 0


def test_old_copy_without_a_kpi_fails_what_checks_it(spark, sides):
    catalog, old = {("m", "h"): KPIS}, {("m", "h"): ["i1"]}
    asked = [task(1, 1), task(2, 5, "i1"), task(3, 0, "I2")]
    results, _ = run(spark, sides, *asked, catalog=catalog, old_catalog=old)
    assert [results["m", st]["status"] for st in (1, 5, 0)] == [2, -1, 2]
    results, _ = run(spark, sides, *asked, catalog=catalog, old_catalog={})
    assert {r["status"] for r in results.values()} == {2}


def test_names_in_upper_case_are_the_same_names(spark, sides):
    new, old = sides
    slices = ["sd", "st", "mo", "i1", "i2"]
    tables = {("m", "h"): new.where("motype = 'm'").select(*slices)}
    upper = {("m", "h"): old.where("motype = 'm'").select(*[F.col(c).alias(c.upper()) for c in slices])}
    catalog, old_catalog = catalog_of(tables), catalog_of(upper)
    assert catalog == old_catalog == {("m", "h"): KPIS}
    facts = facts_of(spark, tables, catalog), facts_of(spark, upper, catalog)
    asked = spark.createDataFrame([task(1, 1), task(2, 0)], TASK_SCHEMA)
    batch = reconcile_batch(asked, *facts, value_columns(catalog), catalog, old_catalog)
    assert {r["st"]: (r["all_n"], r["error_n"], r["status"]) for r in batch.results.collect()} == {1: (6, 3, -1), 0: (6, 0, 1)}


def test_no_tasks(spark, sides):
    batch = reconcile_batch(spark.createDataFrame([], TASK_SCHEMA), *sides, KPIS)
    assert batch.results.isEmpty() and batch.details.isEmpty()


def outputs(tmp_path):
    return [str(tmp_path / name) for name in ("ledger", "results", "details")]


def test_runs_on_disk(spark, sides, tmp_path):
    tasks = spark.createDataFrame([task(i, i) for i in range(3)], TASK_SCHEMA)
    paths = outputs(tmp_path)
    for _ in range(2):  # the second attempt takes the place of the first
        run_batch(tasks, *sides, KPIS, "a", *paths, at=at())
    runs = runs_of(spark, paths[0])
    ledger, results, details = runs.read_ledger(paths[0]), runs.read(paths[1]), runs.read(paths[2])
    assert ledger.groupBy("attempt", "seq").count().where("count = 3").count() == 3
    assert results.count() == 3 and details.count() == 2
    latest = {r["task_id"]: r["status"] for r in task_plans.latest_status(ledger).collect()}
    assert latest == {0: 1, 1: -1, 2: 2}
    failed = results.where("status = 2").first()
    assert failed["all_n"] is None and failed["finish_time"] is None

    run_batch(tasks.where("task_id = 1"), *sides, KPIS, "b", *paths, at=at("2024-02-02 00:00:00"), threshold=0.1)
    latest = {r["task_id"]: r["status"] for r in task_plans.latest_status(runs.read_ledger(paths[0])).collect()}
    assert latest == {0: 1, 1: 1, 2: 2}
    more = spark.createDataFrame([task(2, 2), task(3, 3)], TASK_SCHEMA)
    assert [r["task_id"] for r in pending_tasks(more, runs.read_ledger(paths[0])).collect()] == [3]
    assert [runs.remove_superseded("a", p) for p in paths] == [1, 1, 1]
    assert runs.read(paths[1]).count() == 4 and Path(paths[1], "run=a").is_dir()


def test_a_repeated_run_without_mismatches_leaves_no_details(spark, sides, tmp_path):
    tasks = spark.createDataFrame([task(1, 1)], TASK_SCHEMA)
    paths = outputs(tmp_path)
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    held = set(folder.iterdir())
    run_batch(tasks, *sides, KPIS, "r1", *paths, at=at())
    runs = runs_of(spark, paths[0])
    assert runs.read(paths[2]).count() == 2
    run_batch(tasks, sides[0], sides[0], KPIS, "r1", *paths, at=at())
    assert runs.read(paths[2]).count() == 0
    assert runs.read(paths[1]).first()["status"] == 1
    assert set(folder.iterdir()) == held  # nothing in between stays


@pytest.mark.parametrize("last", ["results", "outcome", "commit"])
def test_a_repeat_that_stops_leaves_the_former_run_whole(spark, sides, tmp_path, monkeypatch, last):
    tasks = spark.createDataFrame([task(1, 1), task(2, 0)], TASK_SCHEMA)
    paths = outputs(tmp_path)
    run_batch(tasks, *sides, KPIS, "r1", *paths, at=at("2024-01-01 00:00:00"))
    runs = runs_of(spark, paths[0])
    before = [sorted(map(str, runs.read(p).collect())) for p in paths[1:]]

    write, commit = Runs.write, Runs.commit

    def stops(self, df, path, attempt, **parts):
        if (last, path, parts) in (("results", paths[1], {}), ("outcome", paths[0], {"seq": 1})):
            raise InterruptedError
        write(self, df, path, attempt, **parts)

    def no_commit(self, attempt, written):
        raise InterruptedError

    monkeypatch.setattr(Runs, "write", stops)
    monkeypatch.setattr(Runs, "commit", no_commit)
    with pytest.raises(InterruptedError):
        run_batch(tasks.where("task_id = 1"), sides[0], sides[0], KPIS, "r1", *paths, at=at("2024-01-02 00:00:00"))
    assert [sorted(map(str, runs.read(p).collect())) for p in paths[1:]] == before
    latest = {r["task_id"]: (r["status"], r["stamp"]) for r in task_plans.latest_status(runs.read_ledger(paths[0])).collect()}
    assert latest == {1: (3, 20240102000000), 2: (1, 20240101000000)}

    monkeypatch.setattr(Runs, "write", write)
    monkeypatch.setattr(Runs, "commit", commit)
    third = run_batch(tasks, sides[0], sides[0], KPIS, "r1", *paths, at=at("2024-01-03 00:00:00"))
    assert third.number == 3 and runs.read(paths[2]).isEmpty() and runs.read(paths[1]).count() == 2
    latest = {r["task_id"]: r["status"] for r in task_plans.latest_status(runs.read_ledger(paths[0])).collect()}
    assert latest == {1: 1, 2: 1}


def test_attempts_have_numbers_of_their_own(spark, tmp_path):
    runs = Runs(spark, str(tmp_path / "runs"))
    assert runs.committed().collect() == []
    first, second = runs.begin("a"), Runs(spark, str(tmp_path / "runs")).begin("a")
    assert (first.number, second.number, runs.begin("a.b").number) == (1, 2, 1)
    runs.commit(second, [])
    runs.commit(first, [])  # the earlier one, committed late, does not count
    assert [tuple(r) for r in runs.committed().collect()] == [("a", 2)]


def test_tasks_may_come_from_the_ledger_of_the_run(spark, sides, tmp_path):
    paths = outputs(tmp_path)
    sheet = spark.createDataFrame([task(1, 1), task(2, 0)], TASK_SCHEMA)
    run_batch(sheet.where("task_id = 2"), *sides, KPIS, "a", *paths, at=at())
    runs = runs_of(spark, paths[0])
    pending = pending_tasks(sheet, runs.read_ledger(paths[0]))
    run_batch(pending, *sides, KPIS, "b", *paths, at=at())
    assert runs.read(paths[1]).where("run = 'b'").count() == 1


def test_runs_in_one_second_keep_their_order(spark):
    rows = [(1, 0, 3, 100, "a"), (1, 1, -1, 101, "a"), (1, 0, 3, 101, "b")]
    ledger = spark.createDataFrame(rows, "task_id long, seq int, status int, stamp long, run string")
    assert task_plans.latest_status(ledger).first()["status"] == 3


def test_names_of_runs_are_folder_names(spark, sides, tmp_path):
    tasks = spark.createDataFrame([task(1, 1)], TASK_SCHEMA)
    with pytest.raises(ValueError, match="folder name"):
        run_batch(tasks, *sides, KPIS, "a/b", *[str(tmp_path / n) for n in "abc"])


def test_many_slots(spark):
    models = spark.createDataFrame([("a",)], "motype string")
    slots = [(20240101 + d, t) for d in range(300) for t in range(24)]
    assert task_plans.generate_tasks(models, "h", slots).count() == 7200
    days = F.lit("2015-01-01").cast("date"), F.lit("2024-12-28").cast("date")
    found = task_plans.generate_tasks_range(models, *days, F.sequence(F.lit(0), F.lit(23)))
    assert found.count() == 3650 * 24
    assert found.agg(F.min("start_day"), F.max("sheet_day_3")).first() == (20150101, 20241228)


def test_more_kpis_than_bits_in_a_word(spark):
    kpis = [f"i{n}" for n in range(130)]
    base = spark.range(50).select(
        F.lit("m").alias("motype"),
        F.lit("h").alias("period"),
        F.lit(20240101).alias("sd"),
        F.lit(0).alias("st"),
        F.col("id").alias("mo"),
        *[F.lit(1.0).alias(k) for k in kpis],
    )
    off = {
        "i0": F.when(F.col("mo") < 3, 5.0).otherwise(1.0),
        "i62": F.when(F.col("mo") == 7, None).otherwise(F.lit(1.0)),
        "i63": F.when(F.col("mo") == 1, 5.0).otherwise(1.0),
        "i129": F.when(F.col("mo") > 40, 5.0).otherwise(1.0),
    }
    asked = spark.createDataFrame([task(1, 0, "i129,i63,i62,i0")], TASK_SCHEMA)
    batch = reconcile_batch(asked, base, base.withColumns(off), kpis)
    row = batch.results.first()
    assert (row["all_n"], row["error_n"], row["null_n"], row["status"]) == (200, 13, 1, -1)
    fields = {r["mo"]: r["fields"] for r in batch.details.collect()}
    assert fields == {
        0: "[i0]",
        1: "[i63, i0]",
        2: "[i0]",
        **{mo: "[i129]" for mo in range(41, 50)},
    }


def test_generated_sheets(spark):
    models = spark.createDataFrame([("a",), ("b",)], "motype string")
    rows = [tuple(r) for r in task_plans.generate_tasks(models).orderBy("motype").collect()]
    assert rows == [(m, "h", 20190926, 0, 20190926, 20190926, 20190926) for m in ("a", "b")]
    assert task_plans.generate_tasks(models, "d", [(20240101, 0), (20240102, 5)]).count() == 4


def test_known_figures(spark):
    sf_dir = "/root/testdata/sf0.01"
    tasks = fx.event_tasks(spark, sf_dir).select(
        *[c for c in TASK_SCHEMA_NAMES if c not in ("indicators", "moentities")],
        F.lit("i1,i3").alias("indicators"),
        F.lit(None).cast("string").alias("moentities"),
    )
    new, old = fx.events_new(spark, sf_dir), fx.events_old(spark, sf_dir)
    results = reconcile_batch(tasks.where("start_time < 24"), new, old, fx.EVENT_KPIS).results
    found = {
        r["status"]: (r["n"], r["fields"], r["errors"])
        for r in results.groupBy("status")
        .agg(F.count("*").alias("n"), F.sum("all_n").alias("fields"), F.sum("error_n").alias("errors"))
        .collect()
    }
    assert found == {1: (689, 18_340, 0), -1: (30, 764, 382), 2: (1, 0, 0)}


TASK_SCHEMA_NAMES = [part.split()[0] for part in TASK_SCHEMA.split(", ")]
