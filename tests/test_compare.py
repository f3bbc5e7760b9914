"""Matching and comparing, on rows small enough to check by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from slicecheck.operators import compare, keys
from slicecheck.operators.casting import cast_failures, typed_projection
from slicecheck.operators.digests import digest_row_diff
from slicecheck.operators.prefilter import may_be_listed, restrict_to_listed
from slicecheck.plans.summary import report_details, summarize

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "mo bigint, i1 double, i2 double"
KPIS = ["i1", "i2"]
NAN, INF = float("nan"), float("inf")


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def wide(new, old, kpis=KPIS):
    rows = compare.compare_wide(new, old, ["mo"], kpis).collect()
    return {r["mo"]: r for r in rows}


def summary(new, old, kpis=KPIS):
    return summarize(compare.compare_wide(new, old, ["mo"], kpis), [], len(kpis)).first()


def test_tolerance_boundary_nan_infinity_and_nulls(spark):
    new = frame(
        spark, (1, 0.01, 0.0), (2, 0.0101, 0.0), (3, NAN, NAN), (4, None, 5.0), (5, INF, None), (6, INF, 1.0)
    )
    old = frame(
        spark, (1, 0.0, 0.0), (2, 0.0, 0.0), (3, 1.0, NAN), (4, 1.0, 6.0), (5, INF, None), (6, -INF, 1.0)
    )
    found = wide(new, old)
    assert {mo: list(r["bad"]) for mo, r in found.items()} == {
        1: [],
        2: ["i1"],
        3: ["i1", "i2"],
        4: ["i2"],
        5: ["i1"],  # the difference of two infinities is no number
        6: ["i1"],
    }
    assert {mo: r["null_pairs"] for mo, r in found.items()} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 0}


def test_rate_must_exceed_the_threshold(spark):
    new = spark.range(1, 201).select(F.col("id").alias("mo"), F.lit(1.0).alias("i1"))
    off = {n: new.withColumn("i1", F.when(F.col("mo") <= n, 2.0).otherwise(1.0)) for n in (1, 2)}
    assert tuple(summary(new, off[2], ["i1"])) == (200, 198, 2, 0.99, -1)
    assert tuple(summary(new, off[1], ["i1"])) == (200, 199, 1, 0.995, 1)


def test_null_pairs_count_as_right(spark):
    new, old = frame(spark, (1, None, None)), frame(spark, (1, 1.0, 2.0))
    assert tuple(summary(new, old)) == (2, 2, 0, 1.0, 1)


def test_no_matched_key_fails_with_a_null_rate(spark):
    row = summary(frame(spark, (1, 1.0, 1.0)), frame(spark, (2, 1.0, 1.0)))
    assert tuple(row) == (0, 0, 0, None, 2)
    empty = frame(spark)
    assert tuple(summary(empty, empty)) == (0, 0, 0, None, 2)


def test_duplicates_on_either_side_fail(spark):
    once, twice = frame(spark, (1, 1.0, 1.0), (2, 1.0, 1.0)), frame(
        spark, (1, 1.0, 1.0), (1, 1.0, 1.0), (2, 1.0, 1.0)
    )
    for new, old in ((once, twice), (twice, once)):
        assert summary(new, old)["status"] == 2
        assert [r["mo"] for r in keys.duplicate_keys(new, old, ["mo"]).collect()] == [1]


def test_null_keys_match_nothing(spark):
    side = frame(spark, (None, 1.0, 1.0), (None, 2.0, 2.0), (1, 1.0, 1.0))
    assert tuple(summary(side, side)) == (2, 2, 0, 1.0, 1)
    counts = keys.side_counts(side, side, ["mo"]).first().asDict()
    assert counts == {
        "new_rows": 3,
        "old_rows": 3,
        "new_null_keys": 2,
        "old_null_keys": 2,
        "new_bad_keys": 0,
        "old_bad_keys": 0,
        "matched_keys": 1,
        "only_new_keys": 0,
        "only_old_keys": 0,
    }


def test_text_side_is_converted_and_junk_fails_the_slice(spark):
    new = frame(spark, (1, 1.0, 1.0), (2, 1.0, None), (3, 1.0, 1.0))
    text = "mo string, i1 string, i2 string"
    good = frame(spark, ("1", "1.005", "1"), ("2", "1", "junk"), schema=text)
    assert tuple(summary(new, good)) == (4, 4, 0, 1.0, 1)  # junk is never compared here
    key = good.union(frame(spark, ("x", "junk", "1"), schema=text))
    assert tuple(summary(new, key)) == (4, 4, 0, 1.0, 2)  # a key that is no number
    assert keys.side_counts(new, key, ["mo"]).first()["old_bad_keys"] == 1
    bad = frame(spark, ("1", "1", "1"), ("3", "1", "junk"), schema=text)
    assert summary(new, bad)["status"] == 2
    counts = {r["kpi"]: r["n"] for r in cast_failures(key, KPIS).collect()}
    assert counts == {"i1": 1, "i2": 1}


def test_typed_projection_drops_other_columns(spark):
    df = frame(spark, ("7", 1, "2.5", "x"), schema="mo string, i1 int, i2 string, k1 string")
    typed = typed_projection(df, KPIS)
    assert typed.dtypes == [("mo", "bigint"), ("i1", "double"), ("i2", "double")]
    assert tuple(typed.first()) == (7, 1.0, 2.5)


def test_exact_difference_keeps_types(spark):
    schema = "mo bigint, i1 string, i2 bigint"
    new = frame(spark, (1, "abc", 9007199254740993), (2, "1", 5), schema=schema)
    old = frame(spark, (1, "xyz", 9007199254740992), (2, "1.0", 5), schema=schema)
    fields = {r["mo"]: r["fields"] for r in compare.exact_field_diff(new, old, ["mo"], KPIS).collect()}
    assert fields == {1: "[i1, i2]", 2: "[i1]"}


def test_fractional_keys_are_not_cut_off(spark):
    side = frame(spark, (1.2, 1.0, 1.0), (1.7, 1.0, 1.0), (2.0, 1.0, 1.0), schema="mo double, i1 double, i2 double")
    assert keys.duplicate_keys(side, side, ["mo"]).isEmpty()
    assert tuple(summary(side, side)) == (2, 2, 0, 1.0, 2)


def test_junk_is_noticed_in_long_form(spark):
    text = "mo string, i1 string, i2 string"
    new = compare.melt(frame(spark, (1, 1.0, None)), ["mo"], KPIS)
    old = compare.melt(frame(spark, ("1", "junk", "junk"), schema=text), ["mo"], KPIS)
    found = {r["kpi"]: (r["is_bad"], r["is_failed"]) for r in compare.compare_long(new, old, ["mo"]).collect()}
    assert found == {"i1": (False, True), "i2": (False, False)}


def test_exact_difference_is_null_safe(spark):
    new = frame(spark, (1, None, 1.0), (2, None, 2.0), (3, 1.0, 3.0), (3, 1.0, 3.0), (4, 1.0, 1.0))
    old = frame(spark, (1, None, 1.0), (2, 1.0, 2.0), (4, 1.0, 1.001))
    rows = {r["mo"] for r in compare.exact_row_diff(new, old).collect()}
    assert rows == {2, 3, 4} == {r["mo"] for r in new.subtract(old).collect()}
    fields = {r["mo"]: r["fields"] for r in compare.exact_field_diff(new, old, ["mo"], KPIS).collect()}
    assert fields == {2: "[i1]", 4: "[i2]"}


def test_wide_equals_long_and_counts_add_up(spark):
    new, old = fx.orders_new(spark, SF_DIR), fx.orders_old(spark, SF_DIR)
    cmp = compare.compare_wide(new, old, ["mo"], fx.ORDER_KPIS)
    by_name = {
        (r["mo"], k) for r in cmp.where("n_bad > 0").collect() for k in r["bad"]
    }
    long_form = compare.compare_long(
        compare.melt(new, ["mo"], fx.ORDER_KPIS), compare.melt(old, ["mo"], fx.ORDER_KPIS), ["mo"]
    )
    melted = {(r["mo"], r["kpi"]) for r in long_form.where("is_bad").collect()}
    entries = compare.field_mismatches(new, old, ["mo"], fx.ORDER_KPIS).collect()
    assert by_name == melted == {(r["mo"], r["kpi"]) for r in entries}

    total = summarize(cmp, [], len(fx.ORDER_KPIS)).first()
    assert total["right_n"] + total["error_n"] == total["all_n"] == long_form.count()
    per_kpi = compare.errors_by_kpi(new, old, ["mo"], fx.ORDER_KPIS).agg(F.sum("n")).first()[0]
    assert per_kpi == total["error_n"] == len(by_name)


def test_key_sets_add_up(spark):
    new, old = fx.orders_new(spark, SF_DIR), fx.orders_old(spark, SF_DIR)
    both = keys.key_intersection(new, old, ["mo"]).count()
    only = keys.keys_only_new(new, old, ["mo"]).count()
    assert both + only == new.select("mo").distinct().count()
    assert both == new.join(old, "mo", "left_semi").count()


def test_a_copy_agrees_with_itself(spark):
    new = fx.orders_new(spark, SF_DIR)
    cmp = compare.compare_wide(new, new, ["mo"], fx.ORDER_KPIS)
    assert summarize(cmp, [], 4).first()["error_n"] == 0
    assert compare.exact_row_diff(new, new).isEmpty()


def test_one_key_with_most_rows(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("mo"),
        F.lit(1.0).alias("i1"),
        F.lit(2.0).alias("i2"),
    )
    row = summary(hot, hot)
    assert row["status"] == 2 and row["all_n"] == 2 * 10_000
    dup = keys.duplicate_keys(hot, hot, ["mo"]).collect()
    assert [tuple(r) for r in dup] == [(7, 20_000, 20_000)]


def test_known_figures(spark):
    sf_dir = "/root/testdata/sf0.01"
    new, old = fx.orders_new(spark, sf_dir), fx.orders_old(spark, sf_dir)
    assert tuple(summary(new, old, fx.ORDER_KPIS)) == (57_796, 57_501, 295, 0.994895840542598, 1)
    fail = summary(new, fx.orders_old_fail(spark, sf_dir), fx.ORDER_KPIS)
    assert (fail["error_n"], fail["rate"], fail["status"]) == (1_461, 0.974721434009274, -1)
    nulls = {r["kpi"]: r["n"] for r in compare.null_pairs(new, old, ["mo"], fx.ORDER_KPIS).collect()}
    assert nulls == {"i1": 0, "i2": 173, "i3": 0, "i4": 0}
    assert compare.exact_row_diff(new, old).count() == 916


def test_details_follow_the_verdict(spark):
    rows = [(s, mo, 1.0, 1.0) for s in ("good", "bad") for mo in range(100)]
    new = frame(spark, *rows, schema="s string, mo bigint, i1 double, i2 double")
    off = F.col("mo") < F.when(F.col("s") == "bad", 5).otherwise(1)
    old = new.withColumn("i2", F.when(off, 7.0).otherwise(F.col("i2")))
    cmp = compare.compare_wide(new, old, ["s", "mo"], KPIS)

    def found(by, **options):
        return sorted((r["s"], r["mo"]) for r in report_details(cmp, by, 2, **options).collect())

    bad = [("bad", mo) for mo in range(5)]
    assert found(["s"]) == bad
    assert found(["s"], always=True) == [*bad, ("good", 0)]
    alone = compare.compare_wide(new.where("s = 'good'"), old.where("s = 'good'"), ["mo"], KPIS)
    assert report_details(alone, [], 2).isEmpty()
    assert [tuple(r) for r in report_details(alone, [], 2, threshold=0.999).collect()] == [(0, "[i2]")]


def test_row_difference_by_digest(spark):
    schema = "a int, b string, c double, d date"
    nan = float("nan")
    new = [(None, "1", 0.0, None), (1, None, -0.0, None), (1, "", nan, None), (1, "x", 1.0, None), (1, "x", 1.0, None),
           (None, None, None, None), (2, "ab", 2.0, None), (3, "y", None, None)]
    old = [(1, None, 0.0, None), (1, "", nan, None), (None, "x", 1.0, None), (2, "a", 2.0, None), (None, None, 3.0, None)]
    sides = [spark.createDataFrame(rows, schema) for rows in (new, old)]
    for left, right in (sides, sides[::-1], (sides[0], sides[1].limit(0)), (sides[0].limit(0), sides[1])):
        expected = compare.exact_row_diff(left, right)
        found = digest_row_diff(left, right)
        assert found.columns == expected.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert digest_row_diff(*sides).count() == 5
    # Columns in another order; nested ones have no digest.
    assert digest_row_diff(sides[0], sides[1].select("d", "c", "b", "a")).count() == 5
    with pytest.raises(ValueError):
        digest_row_diff(*[s.select(F.array("a").alias("a")) for s in sides])
    with pytest.raises(ValueError):
        digest_row_diff(sides[0], sides[1].withColumn("a", F.col("a").cast("long")))


def test_wide_rows_that_are_equal_stay_out_of_the_shuffle(spark, tmp_path):
    kpis = [F.expr(f"id * {n} + 0.5D").alias(f"i{n}") for n in range(300)]
    spark.range(2000).select(F.col("id").alias("mo"), *kpis).write.parquet(str(tmp_path / "new"))
    new = spark.read.parquet(str(tmp_path / "new"))
    old = new.withColumn("i7", F.when(F.col("mo") % 500 == 0, -1.0).otherwise(F.col("i7")))
    found = digest_row_diff(new, old)
    assert sorted(r.mo for r in found.collect()) == [0, 500, 1000, 1500]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_long_lists_are_filtered_before_the_join(spark, tmp_path):
    spark.range(100_000).selectExpr("id AS mo", "cast(id % 7 AS string) AS day", "id * 0.5D AS i1").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    listed = spark.range(3000).selectExpr("id * 21 AS mo", "'0' AS day").unionAll(spark.range(50).selectExpr("21L AS mo", "'0' AS day"))
    for keys in (["mo"], ["day", "mo"]):
        found = restrict_to_listed(rows, listed, keys, sent_keys=100)
        assert sorted(r.mo for r in found.collect()) == [21 * i for i in range(3000)] and found.columns == rows.columns
        plan = found._jdf.queryExecution().executedPlan().toString()
        # The filter stands between the scan of the rows and the join.
        assert plan.index("Join") < plan.index("getbit") < plan.index(str(tmp_path))
        passing = rows.where(may_be_listed(listed.distinct(), keys, 3000)).count()
        assert 3000 <= passing <= 3000 + 0.05 * 97_000
    assert restrict_to_listed(rows, listed, ["mo"]).count() == 3000  # sent whole
    nulls = spark.createDataFrame([(None, "0"), (42, None), (42, None), (-5, "0")], "mo long, day string")
    for sent in (0, 100):
        assert restrict_to_listed(nulls, listed, ["mo"], sent).count() == 2
        assert restrict_to_listed(nulls, nulls, ["mo", "day"], sent).count() == 1
        assert restrict_to_listed(rows, listed.limit(0), ["mo"], sent).count() == 0
        assert restrict_to_listed(rows.limit(0), listed, ["mo"], sent).count() == 0
