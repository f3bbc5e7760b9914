"""Many random slices against a plain restatement of the rules, in one batch each."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from slicecheck.plans.batch import reconcile_batch
from slicecheck.sources.tasks import TASK_SCHEMA

KPIS = ["i1", "i2", "i3"]
FACTS = "motype string, period string, sd int, st int, mo bigint, i1 double, i2 double, i3 double"
VALUES = [None, 0.0, 0.01, 0.0101, 1.0, -1.0, float("nan"), float("inf")]
LISTS = [None, "i1", "i3,i1", "i2,i2,,", " I2", "mo,i1", "i4", "i1,,i2", ",", ""]
ENTITIES = [None, None, "1,2,3", "2,,x,", ",", "99"]


def random_rows(rng, slices):
    rows = []
    for st in range(slices):
        keys = rng.sample(range(1, 9), rng.randint(0, 8))
        if rng.random() < 0.15 and keys:
            keys.append(keys[0])
        if rng.random() < 0.2:
            keys.append(None)
        calm = rng.random() < 0.5
        for mo in keys:
            values = [1.0 if calm else rng.choice(VALUES) for _ in KPIS]
            rows.append(("m", "h", 20240101 + st % 3, st, mo, *values))
    return rows


def java_split(text):
    parts = text.split(",")
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    return [] if parts == [""] and text else parts


def expected(new, old, indicators, entities):
    """Counts, status and details of one slice, as the rules have it."""
    labels = KPIS if indicators is None else java_split(indicators)
    labels = [x for x in labels if x.strip().lower() != "mo"]
    names = [x.strip().lower() for x in labels]
    listed = None
    if entities is not None:
        listed = {int(x) for x in java_split(entities) if x.strip().isdigit()}
    sides = []
    for rows in (new, old):
        sides.append([r for r in rows if r[4] is not None and (listed is None or r[4] in listed)])
    counts = [Counter(r[4] for r in rows) for rows in sides]
    duplicated = any(n > 1 for count in counts for n in count.values())
    by_key = [{r[4]: dict(zip(KPIS, r[5:])) for r in rows} for rows in sides]
    matched = [k for k in counts[0] if counts[0][k] == 1 and counts[1][k] == 1]
    bad = {}
    for key in matched:
        fields = []
        for label, name in zip(labels, names):
            x, y = by_key[0][key].get(name), by_key[1][key].get(name)
            if x is not None and y is not None and not abs(x - y) <= 0.01:
                fields.append(label)
        if fields:
            bad[key] = "[" + ", ".join(fields) + "]"
    all_n = len(matched) * len(labels)
    error_n = sum(len(text.split(", ")) for text in bad.values())
    if not matched or duplicated or any(n not in KPIS for n in names):
        return all_n, None, 2, {}
    rate = (all_n - error_n) / all_n if all_n else math.nan
    return all_n, error_n, 1 if rate > 0.99 else -1, bad if not rate > 0.99 else {}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_slices(spark, seed):
    rng = random.Random(seed)
    slices = 400
    new = random_rows(rng, slices)
    old = random_rows(rng, slices)
    same = rng.sample(range(slices), slices // 3)  # slices that agree but for a value or two
    old = [r for r in old if r[3] not in same]
    for row in new:
        if row[3] in same:
            changed = list(row)
            if rng.random() < 0.03:
                changed[5] = rng.choice(VALUES)
            old.append(tuple(changed))
    lists = {st: (rng.choice(LISTS), rng.choice(ENTITIES)) for st in range(slices)}
    tasks = [(st, "m", "h", 20240101 + st % 3, st, *lists[st]) for st in range(slices)]
    tasks += [(1000 + st, "m", "h", 20240101 + st % 3, st, "i1", None) for st in range(0, slices, 5)]
    rng.shuffle(tasks)

    batch = reconcile_batch(
        spark.createDataFrame(tasks, TASK_SCHEMA),
        spark.createDataFrame(new, FACTS),
        spark.createDataFrame(old, FACTS),
        KPIS,
    )
    found = {r["st"]: r for r in batch.results.collect()}
    details = {}
    for r in batch.details.collect():
        details.setdefault(r["st"], {})[r["mo"]] = r["fields"]

    seen = Counter()
    assert sorted(found) == list(range(slices))
    for st in range(slices):
        all_n, error_n, status, bad = expected(
            [r for r in new if r[3] == st], [r for r in old if r[3] == st], *lists[st]
        )
        row = found[st]
        assert (row["all_n"], row["status"]) == (all_n, status), (st, lists[st])
        if error_n is not None:
            assert row["error_n"] == error_n and row["right_n"] == all_n - error_n
        assert details.get(st, {}) == bad
        seen[status] += 1
    assert min(seen[1], seen[-1], seen[2]) > 10
