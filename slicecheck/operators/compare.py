"""Compare the KPIs of matched rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicecheck.functions.text import bracket_list
from slicecheck.operators.pairs import (
    COUNTS,
    exceeds,
    has_bit,
    is_matched,
    mismatch_words,
    pair_differences,
    pair_rows,
    words_of,
)
from slicecheck.operators.casting import column_type, long_counts, not_castable
from slicecheck.settings import ENTITY, TOLERANCE


def matched_rows(
    new: DataFrame, old: DataFrame, keys: Sequence[str], kpis: Sequence[str]
) -> DataFrame:
    """The rows found once on each side, with both values of every KPI."""
    values = [c for k in kpis for c in (f"x_{k}", f"y_{k}")]
    return pair_rows(new, old, keys, kpis).where(is_matched()).select(*keys, *values)


def compare_wide(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str],
    kpis: Sequence[str],
    tol: float = TOLERANCE,
) -> DataFrame:
    """One row per key. ``n_bad``, ``null_pairs`` and ``n_failed`` count KPIs of
    matched keys; ``bad`` names the mismatching ones in the order of ``kpis``.
    """
    pairs = _with_errors(new, old, keys, kpis, tol)
    return pairs.select(
        *keys,
        *COUNTS,
        _count_bits("err", kpis).alias("n_bad"),
        _count_bits("null", kpis).alias("null_pairs"),
        _count_bits("fail", kpis).alias("n_failed"),
        named_kpis({k: has_bit("err", n) for n, k in enumerate(kpis)}).alias("bad"),
    )


def named_kpis(conditions: dict[str, Column]) -> Column:
    """Array of the names whose condition holds."""
    names = [F.when(condition, k).otherwise("") for k, condition in conditions.items()]
    return F.array_remove(F.array(*names), "")


def mismatch_detail(cmp: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The differing KPIs of each entity as text; entities without any are left out."""
    differing = cmp.where(is_matched() & (F.col("n_bad") > 0))
    return differing.select(*keys, bracket_list(F.col("bad")).alias("fields"))


def field_mismatches(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str],
    kpis: Sequence[str],
    tol: float = TOLERANCE,
) -> DataFrame:
    """One row per mismatching value. The values are put below each other only
    after the wide comparison, so the shuffle carries one row per key.
    """
    pairs = pair_rows(new, old, keys, kpis).where(is_matched())
    diff = {k: F.col(f"x_{k}") - F.col(f"y_{k}") for k in kpis}
    entries = [
        F.struct(
            F.lit(k).alias("kpi"),
            F.col(f"x_{k}").alias("x"),
            F.col(f"y_{k}").alias("y"),
            diff[k].alias("diff"),
        )
        for k in kpis
    ]
    return (
        pairs.where(reduce(or_, [exceeds(d, tol) for d in diff.values()]))
        .select(*keys, F.inline(F.array(*entries)))
        .where(exceeds(F.col("diff"), tol))
    )


def melt(df: DataFrame, keys: Sequence[str], kpis: Sequence[str]) -> DataFrame:
    """Long form ``keys, kpi, value, failed`` of a wide KPI table; ``failed`` marks values
    that are no numbers. For a comparison of two wide tables see :func:`field_mismatches`.
    """
    entries = [
        F.struct(
            F.lit(k).alias("kpi"),
            F.col(k).try_cast("double").alias("value"),
            not_castable(F.col(k), "double").alias("failed"),
        )
        for k in kpis
    ]
    return df.select(*keys, F.inline(F.array(*entries)))


def compare_long(
    new: DataFrame, old: DataFrame, keys: Sequence[str], tol: float = TOLERANCE
) -> DataFrame:
    """Compare two tables in long form, for sources that are long already; for wide ones see
    :func:`compare_long_of`.
    One row per matched (key, kpi): ``x``, ``y``, ``diff``, ``is_bad``, and ``is_failed``
    where a side has a value that is no number and the other is not null.
    """
    sides = [
        side.withColumn("failed", F.col("failed").cast("int")) if "failed" in side.columns
        else side.withColumn("failed", F.lit(0))
        for side in (new, old)
    ]
    pairs = pair_rows(*sides, [*keys, "kpi"], ["value", "failed"]).where(is_matched())
    x, y = F.col("x_value"), F.col("y_value")
    x_failed, y_failed = F.col("x_failed") > 0, F.col("y_failed") > 0
    both_set = (x.isNotNull() | x_failed) & (y.isNotNull() | y_failed)
    return pairs.select(
        *keys,
        "kpi",
        x.alias("x"),
        y.alias("y"),
        (x - y).alias("diff"),
        exceeds(x - y, tol).alias("is_bad"),
        (both_set & (x_failed | y_failed)).alias("is_failed"),
    )


def compare_long_of(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str],
    kpis: Sequence[str],
    tol: float = TOLERANCE,
    only_bad: bool = False,
) -> DataFrame:
    """What :func:`compare_long` gives for two wide tables. They are paired as they are, one
    row per key in the shuffle, and put below each other after it."""
    sides = (new, old)
    text = [k for k in kpis if any(isinstance(column_type(s, k), T.StringType) for s in sides)]
    marked = sides if not text else [
        side.withColumns({f"_failed_{k}": not_castable(F.col(k), "double").cast("int") for k in text}) for side in sides
    ]
    pairs = pair_rows(*marked, keys, [*kpis, *[f"_failed_{k}" for k in text]]).where(is_matched())
    entries, bad = [], []
    for k in kpis:
        x, y, failed = F.col(f"x_{k}"), F.col(f"y_{k}"), F.lit(False)
        if k in text:
            x_failed, y_failed = F.col(f"x__failed_{k}") > 0, F.col(f"y__failed_{k}") > 0
            both_set = (x.isNotNull() | x_failed) & (y.isNotNull() | y_failed)
            failed = both_set & (x_failed | y_failed)
        bad.append(exceeds(x - y, tol))
        entry = {"kpi": F.lit(k), "x": x, "y": y, "diff": x - y, "is_bad": bad[-1], "is_failed": failed}
        entries.append(F.struct(*[c.alias(name) for name, c in entry.items()]))
    if only_bad:
        pairs = pairs.where(reduce(or_, bad))
    found = pairs.select(*keys, F.inline(F.array(*entries)))
    return found.where("is_bad") if only_bad else found


def errors_by_kpi(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str],
    kpis: Sequence[str],
    tol: float = TOLERANCE,
) -> DataFrame:
    """Number of mismatches per KPI, and per slice if there are keys before the entity."""
    pairs = _with_errors(new, old, keys, kpis, tol).where(is_matched())
    return _counts_by_kpi(pairs, keys, {k: has_bit("err", n) for n, k in enumerate(kpis)})


def null_pairs(
    new: DataFrame, old: DataFrame, keys: Sequence[str], kpis: Sequence[str]
) -> DataFrame:
    """Number of matched values per KPI that were not compared since a side is null."""
    pairs = pair_differences(new, old, keys, kpis).where(is_matched())
    return _counts_by_kpi(pairs, keys, {k: has_bit("null", n) for n, k in enumerate(kpis)})


def exact_row_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """Distinct rows of ``new`` that ``old`` does not hold. Equal rows are combined
    map-side on both sides before anything is compared.
    """
    columns = new.columns
    sides = new.select(*columns, F.lit(0).alias("is_old")).unionByName(
        old.select(*columns, F.lit(1).alias("is_old"))
    )
    seen = sides.groupBy(*columns).agg(F.max("is_old").alias("in_old"))
    return seen.where("in_old = 0").drop("in_old")


def exact_field_diff(
    new: DataFrame, old: DataFrame, keys: Sequence[str], kpis: Sequence[str]
) -> DataFrame:
    """The KPIs of each matched entity that are not exactly equal, compared as they are
    stored; null equals null only."""
    pairs = pair_rows(new, old, keys, kpis, exact=True).where(is_matched())
    differs = {k: ~F.col(f"x_{k}").eqNullSafe(F.col(f"y_{k}")) for k in kpis}
    fields = bracket_list(named_kpis(differs)).alias("fields")
    return pairs.where(reduce(or_, differs.values())).select(*keys, fields)


def _with_errors(
    new: DataFrame, old: DataFrame, keys: Sequence[str], kpis: Sequence[str], tol: float
) -> DataFrame:
    return pair_differences(new, old, keys, kpis).select("*", *mismatch_words(kpis, tol))


def _count_bits(flag: str, kpis: Sequence[str]) -> Column:
    """Number of KPIs with a flag, for matched rows; 0 for others."""
    total = reduce(add, [F.bit_count(word) for word in words_of(flag, kpis)], F.lit(0))
    return F.when(is_matched(), total).otherwise(0)


def _counts_by_kpi(
    pairs: DataFrame, keys: Sequence[str], conditions: dict[str, Column]
) -> DataFrame:
    by = [k for k in keys if k != ENTITY]
    counts = pairs.groupBy(*by).agg(*[F.count_if(c).alias(k) for k, c in conditions.items()])
    return long_counts(counts, list(conditions), by)
