"""Restriction to long lists of keys: a Bloom filter ahead of the join.

A list too long to be sent whole is joined by shuffle, and then all rows would travel, though
most are not listed. Bits of the listed keys are small at any length of the list, and rows whose
bits are not all set stay where they are read. The join after it makes the result exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicecheck.settings import written

# Lists of so many keys are sent to all tasks as they are.
SENT_KEYS = 100_000
# Bits for each key, and for a list of any length (1 MB), both before rounding to 2^n.
BITS_PER_KEY, MOST_BITS = 10, 1 << 23
# Seeds of the hashes.
_SEEDS = (1, 2, 3)
_WORD = 64


def restrict_to_listed(
    rows: DataFrame, listed: DataFrame, keys: Sequence[str], sent_keys: int = SENT_KEYS
) -> DataFrame:
    """The rows whose keys are listed, with all their columns; null keys match nothing. The
    distinct keys of the list are written and counted first."""
    keys = list(keys)
    wanted = written(listed.select(*keys).dropna().distinct())
    n = wanted.count()
    if n <= sent_keys:
        found = rows.join(F.broadcast(wanted), keys, "left_semi")
    else:
        found = rows.where(may_be_listed(wanted, keys, n)).join(wanted, keys, "left_semi")
    return found.select(*rows.columns)


def may_be_listed(listed: DataFrame, keys: Sequence[str], n: int) -> Column:
    """True for all listed keys and few others, as long as ``n`` is their number or not far from
    it; beyond ``MOST_BITS`` more pass. Types of the keys must be the same on both sides."""
    words = _words(n)
    words_set = (
        listed.select(F.explode(F.array(*_positions(keys, words))).alias("bit"))
        .groupBy(F.shiftrightunsigned("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    )
    every = listed.sparkSession.range(words).select(F.col("id").alias("word"))
    filled = every.join(words_set, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    # ``words`` small rows, in one value: its size is fixed.
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    filter_of = written(filled.agg(F.transform(ordered, lambda w: w["bits"]).alias("bits"))).scalar()
    tests = [
        F.getbit(F.get(filter_of, F.shiftrightunsigned(p, 6).cast("int")), p.bitwiseAND(F.lit(_WORD - 1)).cast("int")) == 1
        for p in _positions(keys, words)
    ]
    return reduce(and_, tests)


def _words(n: int) -> int:
    bits = min(max(n * BITS_PER_KEY, _WORD), MOST_BITS)
    return 1 << (bits // _WORD - 1).bit_length()


def _positions(keys: Sequence[str], words: int) -> list[Column]:
    """The bits of a row's keys."""
    return [F.xxhash64(F.lit(s), *keys).bitwiseAND(F.lit(words * _WORD - 1)) for s in _SEEDS]
