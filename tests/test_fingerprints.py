"""Digests part equal from differing rows; batches by digest give what pairing gives."""

from __future__ import annotations

import random

import pytest

from slicecheck.operators.fingerprints import part_equal
from slicecheck.plans import batch as plans
from slicecheck.sources.tasks import TASK_SCHEMA

KPIS = ["i1", "i2"]
FACTS = "motype string, period string, sd int, st int, mo double, i1 double, i2 string"
NAN = float("nan")


def sides(spark):
    """Slots 0 to 9; what is odd about each stands beside it."""
    chance = random.Random(3)
    new, old = [], []
    for st in range(10):
        rows = [[float(mo), chance.choice([None, 0.5, 7.0]), chance.choice([None, "3", "4.5"])] for mo in range(30)]
        other = [list(r) for r in rows]
        if st == 1:
            other[3][1] = 99.0  # one value
        elif st == 2:
            rows[4][1] = other[4][1] = NAN  # equal, but NaN differs from everything
        elif st == 3:
            rows[5][2] = other[5][2] = "n/a"  # equal, but no number
        elif st == 4:
            rows[6][0] = other[6][0] = None  # equal keys that are null
        elif st == 5:
            rows.append(rows[7])  # equal, and there twice on both sides
            other.append(other[7])
        elif st == 6:
            other[8][1], other[9][1] = 0.505, 7.0  # within the tolerance
            rows[8][1], rows[9][1] = 0.5, 7.0
        elif st == 7:
            rows[2][1:], other[2][1:] = [None, "1"], [1.0, None]  # nulls change places
        elif st == 8:
            other = other[:-1]  # a key less
        elif st == 9:
            rows[1][0] = other[1][0] = 1.5  # equal keys that are no whole numbers
        chance.shuffle(other)
        new += [("m", "h", 20240101, st, *r) for r in rows]
        old += [("m", "h", 20240101, st, *r) for r in other]
    return spark.createDataFrame(new, FACTS).repartition(3), spark.createDataFrame(old, FACTS).repartition(4)


def outputs(batch):
    return [sorted(map(str, df.collect())) for df in (batch.results, batch.details)]


def test_same_as_pairing(spark):
    new, old = sides(spark)
    lists = [None, "i2", "i1,i1"]
    tasks = spark.createDataFrame([(st, "m", "h", 20240101, st, lists[st % 3], None) for st in range(11)], TASK_SCHEMA)
    paired = outputs(plans.reconcile_batch(tasks, new, old, KPIS, always=True))
    assert outputs(plans.reconcile_batch(tasks, new, old, KPIS, always=True, fingerprints=True)) == paired


@pytest.mark.parametrize("bucket_rows", [100_000, 4])
def test_equal_parts_are_not_paired(spark, bucket_rows):
    new, old = sides(spark)
    kept = [df.select("st", "mo", *KPIS) for df in (new, old)]
    parted = part_equal(*kept, "st", KPIS, bucket_rows)
    equal = {r.st: r.n for r in parted.equal.groupBy("st").sum("n").toDF("st", "n").collect()}
    left = {r.st: r["count"] for r in parted.new.groupBy("st").count().collect()}
    assert equal[0] == 30 and 0 not in left
    rows = {r.st: r["count"] for r in new.groupBy("st").count().collect()}
    assert {st: equal.get(st, 0) + left.get(st, 0) for st in rows} == rows
    if bucket_rows == 4:
        # Of slices that differ in one place most buckets are equal.
        assert all(0 < left[st] < 20 for st in range(1, 10))
    else:
        assert set(equal) == {0} and set(left) == set(range(1, 10))


def test_only_suspect_rows_reach_the_shuffle_by_key(spark, monkeypatch):
    new, old = sides(spark)
    seen = []

    def counted(new, old, kpis, tol):
        seen.append((new.count(), old.count()))
        return tally(new, old, kpis, tol)

    tally = plans.tally_slices
    monkeypatch.setattr(plans, "tally_slices", counted)
    tasks = spark.createDataFrame([(st, "m", "h", 20240101, st, None, None) for st in (0, 1)], TASK_SCHEMA)
    plans.reconcile_batch(tasks, new, new, KPIS, fingerprints=True)
    plans.reconcile_batch(tasks, new, old, KPIS, fingerprints=True)
    assert seen == [(0, 0), (30, 30)]


def test_empty_copies(spark):
    new, _ = sides(spark)
    parted = part_equal(*[new.limit(0).select("st", "mo", *KPIS)] * 2, "st", KPIS)
    assert parted.equal.collect() == parted.new.collect() == []
