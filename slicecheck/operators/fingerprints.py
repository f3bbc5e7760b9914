"""Find out which parts of two copies are equal, without pairing their rows.

A digest of a set of rows is their number and the sums of two 64-bit hashes, so it does not
depend on their order, adds up over parts, and combines map-side. The rows of the new copy
count as plus and those of the old one as minus: a part whose digest is nothing is equal.
Digests are taken of whole slices first. Slices that differ are digested again by buckets of
keys, as many as their number of rows calls for, and only the rows of buckets that differ are
paired. Rows are digested apart by which of their values are null, so the null pairs of equal
parts are known as well.

Rows for which equal copies are not enough have a digest that differs between the copies:
those with NaN, with text that is no number, or without a usable key. Duplicates are looked
for among the keys of the new copy alone, as an equal copy has the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicecheck.operators.pairs import bad_key, entity_key, pack_bits, words_of
from slicecheck.settings import ENTITY, written

# Rows of a bucket, about.
BUCKET_ROWS = 100_000
_PARTS = [f"{h}_{part}" for h in ("one", "two") for part in ("low", "high")]


@dataclass(frozen=True)
class Parted:
    """``equal``: ``by``, the null words and ``n`` rows of parts that are equal in both copies;
    ``new`` and ``old``: the rows of all other parts."""

    equal: DataFrame
    new: DataFrame
    old: DataFrame


def part_equal(
    new: DataFrame, old: DataFrame, by: str, kpis: Sequence[str], bucket_rows: int = BUCKET_ROWS
) -> Parted:
    """Parts two copies with ``by, mo`` and the KPIs. ``by`` is one column without nulls."""
    marked = [_marked(new, by, kpis, 1), _marked(old, by, kpis, -1)]
    slices = written(_digests(marked, [by], kpis))
    # Keys that are there more than once, of slices that look equal.
    alike = slices.groupBy(by).agg(_differs().alias("differs"), F.sum("n").alias("n"))
    keys = marked[0].where(F.col(ENTITY).isNotNull()).groupBy(by, ENTITY).agg(F.count("*").alias("copies"))
    doubled = written(keys.where("copies > 1").select(by, ENTITY))
    state = alike.join(doubled.select(by).distinct().withColumn("doubled", F.lit(True)), by, "left")
    buckets = F.greatest(F.ceil(F.col("n") / bucket_rows), F.lit(1)).cast("int").alias("buckets")
    suspects = written(state.where("differs OR doubled").select(by, buckets))
    nulls = words_of("null", kpis)

    equal_slices = slices.join(suspects, by, "left_anti")
    many = suspects.where("buckets > 1")
    # Only slices that differ are read again.
    sides = [_bucketed(side, many, by) for side in marked]
    parts = written(_digests(sides, [by, "bucket"], kpis))
    odd = parts.groupBy(by, "bucket").agg(_differs().alias("differs")).where("differs").select(by, "bucket")
    odd = odd.unionByName(_bucketed(doubled, many, by).select(by, "bucket")).unionByName(
        suspects.where("buckets = 1").select(by, F.lit(0).alias("bucket"))
    )
    odd = written(odd.distinct())
    equal_buckets = parts.join(odd, [by, "bucket"], "left_anti")
    columns = [by, *nulls, "n"]
    return Parted(
        equal_slices.select(*columns).unionByName(equal_buckets.select(*columns)),
        *[_bucketed(side, suspects, by).join(odd, [by, "bucket"], "left_semi").select(*side.columns) for side in (new, old)],
    )


def _bucketed(rows: DataFrame, slices: DataFrame, by: str) -> DataFrame:
    """The rows of these slices, with the bucket of their key."""
    bucket = F.pmod(F.xxhash64(entity_key(rows)), F.col("buckets")).cast("int")
    return rows.join(slices, by).withColumn("bucket", bucket).drop("buckets")


def _marked(side: DataFrame, by: str, kpis: Sequence[str], sign: int) -> DataFrame:
    """``by, mo``, the sign, the null words and the halves of two hashes of each row."""
    numbers = [F.col(k).try_cast("double") for k in kpis]
    odd = [F.isnan(x) | (x.isNull() & F.col(k).isNotNull()) for x, k in zip(numbers, kpis)]
    unusable = entity_key(side).isNull()
    apart = F.when(reduce(lambda a, b: a | b, [F.coalesce(o, F.lit(False)) for o in odd], unusable), sign)
    hashes = [F.xxhash64(F.lit(seed), entity_key(side), apart, *numbers) for seed in (1, 2)]
    halves = [c for h in hashes for c in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
    return side.select(
        by,
        entity_key(side).alias(ENTITY),
        F.lit(sign).cast("bigint").alias("sign"),
        F.coalesce(bad_key(side), F.lit(0)).alias("bad"),
        *pack_bits([f"`{k}` IS NULL" for k in kpis], "null"),
        *[h.alias(p) for h, p in zip(halves, _PARTS)],
    )


def _digests(sides: Sequence[DataFrame], by: Sequence[str], kpis: Sequence[str]) -> DataFrame:
    """``by``, the null words, ``n`` rows of the new copy, and what is left of the digests. A
    sum that does not fit is null."""
    rows = sides[0].unionByName(sides[1])
    sums = [F.expr(f"try_sum(sign * {p})").alias(p) for p in _PARTS]
    return rows.groupBy(*by, *words_of("null", kpis)).agg(
        F.count_if(F.col("sign") > 0).alias("n"), F.sum("sign").alias("more"), *sums
    )


def _differs() -> Column:
    left = [F.coalesce(F.col(p) != 0, F.lit(True)) for p in (*_PARTS, "more")]
    return F.bool_or(reduce(lambda a, b: a | b, left))
