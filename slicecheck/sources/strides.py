"""Ranges of keys with about equally many rows, for reading a database in parallel.

``lowerBound`` and ``upperBound`` make strides of equal length, which is uneven where keys are:
one partition may get most rows. Here the bounds come of a sketch of the keys, taken from any
table that is distributed alike, such as the other copy. A key with more rows than a partition
should have is split further by a second column, usually the day.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicecheck.operators.casting import whole_number
from slicecheck.settings import ENTITY

# Of the sketch: ranks are off by at most rows / (ACCURACY * partitions).
ACCURACY = 50


def stride_bounds(df: DataFrame, column: str, parts: int) -> list[int]:
    """The keys that cut ``df`` into ``parts`` ranges of about equal numbers of rows, in order.
    A key with several shares of the rows is there several times. Empty without any keys."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    key = whole_number(df, column)
    return df.agg(F.percentile_approx(key, shares, ACCURACY * parts)).first()[0] or []


def stride_predicates(
    df: DataFrame, parts: int, column: str = ENTITY, split: str | None = "sd"
) -> list[str]:
    """Conditions on ``column`` that every row of a table meets exactly one of, with about equally
    many rows of ``df`` each; about ``parts`` of them. Keys that are null meet the first one,
    those beyond the bounds the first or last. Only bounds reach the driver, ``parts`` at most.

    A key with two or more shares of the rows gets conditions of its own, cut by ``split``
    (whole numbers) into as many ranges, where it has that many values.
    """
    bounds = stride_bounds(df, column, parts)
    copies = {b: bounds.count(b) for b in dict.fromkeys(bounds)}
    hot = {b: n for b, n in copies.items() if n > 1}
    cuts = _split_bounds(df, column, split, hot) if hot and split else {}
    conditions, low = [], None
    for bound in copies:
        if low != bound:
            conditions.append(_between(column, low, bound))
        low = bound
        if bound in hot:
            low = bound + 1
            conditions += [f"{_between(column, bound, low)}{part}" for part in _parts(split, cuts.get(bound, []))]
    conditions.append(_between(column, low, None))
    # The first range is open below, and takes the nulls.
    return [_with_nulls(column, conditions[0]) or "1 = 1", *conditions[1:]]


def read_strides(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: Sequence[str],
    properties: dict[str, str] | None = None,
    read: Callable[[str], DataFrame] | None = None,
) -> DataFrame:
    """A table of a database, one partition for each condition. ``read`` takes the place of the
    database: it gives the rows that meet a condition."""
    if read is None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties or {})
    return reduce(DataFrame.unionAll, [read(p) for p in predicates])


def _split_bounds(df: DataFrame, column: str, split: str, hot: dict[int, int]) -> dict[int, list[int]]:
    """For each hot key the distinct values of ``split`` that cut its rows evenly."""
    key = whole_number(df, column).alias("_key")
    most = max(hot.values())
    shares = sorted({i / n for n in hot.values() for i in range(1, n)})
    rows = df.select(key, whole_number(df, split).alias("_split")).where(F.col("_key").isin(list(hot)))
    # At most one row for each condition.
    found = rows.groupBy("_key").agg(F.percentile_approx("_split", shares, ACCURACY * most).alias("at")).collect()
    values = {r["_key"]: dict(zip(shares, r["at"] or [])) for r in found}
    return {
        key: sorted({values[key][i / n] for i in range(1, n) if i / n in values.get(key, {})})
        for key, n in hot.items()
    }


def _parts(split: str, cuts: list[int]) -> list[str]:
    """Further conditions of a key's ranges; the lowest one takes the nulls."""
    if not cuts:
        return [""]
    ranges = [_between(split, low, high) for low, high in zip([None, *cuts], [*cuts, None])]
    return [f" AND ({r})" for r in (_with_nulls(split, ranges[0]), *ranges[1:])]


def _with_nulls(column: str, condition: str) -> str:
    return f"{condition} OR {column} IS NULL" if condition else ""


def _between(column: str, low: int | None, high: int | None) -> str:
    """``low`` included, ``high`` not; None is open, and without bounds the text is empty."""
    least = f"{column} >= {low}" if low is not None else ""
    most = f"{column} < {high}" if high is not None else ""
    return " AND ".join(filter(None, [least, most]))
