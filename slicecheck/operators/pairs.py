"""Match the rows of two copies of a table by key.

Both copies are stacked with a side mark and grouped by key once. Against a join
this has three advantages at scale: the grouping combines map-side, so a key
that holds a large share of the rows is reduced before the shuffle and can never
multiply into pairs; keys of one side only, duplicated keys and matched rows come
out of the same pass; and no side needs sorting.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicecheck.operators.casting import whole_number
from slicecheck.settings import BAD_KEY, ENTITY, TOLERANCE

# Flags of this many KPIs share one bigint.
WORD = 63


def pair_rows(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str],
    kpis: Sequence[str],
    exact: bool = False,
) -> DataFrame:
    """One row per key: ``n_new``, ``n_old``, and per KPI ``x_`` (new) and ``y_`` (old), as
    doubles, or with ``exact`` as they are. Rows without an entity key, or with one that
    is no whole number, stay visible under the null key; ``bad_new`` and ``bad_old``
    count the latter.
    """
    value = F.col if exact else _number
    sides = [
        side.select(
            *_keys(side, keys),
            F.lit(1).alias(f"in_{mark}"),
            bad_key(side, keys).alias(f"bad_{mark}"),
            *[value(k).alias(f"{mark}_{k}") for k in kpis],
        )
        for side, mark in ((new, "x"), (old, "y"))
    ]
    stacked = sides[0].unionByName(sides[1], allowMissingColumns=True)
    # A matched key has one row per side, so max is that row's value.
    values = [F.max(f"{mark}_{k}").alias(f"{mark}_{k}") for mark in "xy" for k in kpis]
    return stacked.groupBy(*keys).agg(*_counts(), *values)


def pair_differences(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str],
    kpis: Sequence[str],
) -> DataFrame:
    """One row per key: ``n_new``, ``n_old``, per KPI ``diff_`` (new - old), and as bits of
    the words ``num_``, ``null_`` and ``fail_`` which KPIs are numbers on both sides,
    null on a side, or set on both but no numbers. Differences of other KPIs than the
    first kind, and all of them for keys that are not matched, mean nothing.

    Half as wide in the shuffle as both values: a matched key has one row per side,
    so the sum of the new and the negated old value is their exact difference, and
    which values are there fits into bits.
    """
    flags = {"num": "try_cast(`{}` AS DOUBLE) IS NOT NULL"}
    # Only text can hold a value that is no number.
    if any(isinstance(side.schema[k].dataType, T.StringType) for side in (new, old) for k in kpis):
        flags["set"] = "`{}` IS NOT NULL"
    packed = {flag: pack_bits([test.format(k) for k in kpis], flag) for flag, test in flags.items()}
    words = [f"{flag}_{w}" for flag, columns in packed.items() for w in range(len(columns))]

    sides = [
        side.select(
            *_keys(side, keys),
            F.lit(1).alias(f"in_{mark}"),
            bad_key(side, keys).alias(f"bad_{mark}"),
            *[F.expr(f"{sign}try_cast(`{k}` AS DOUBLE) AS `d_{k}`") for k in kpis],
            *[c for columns in packed.values() for c in columns],
        )
        .withColumnsRenamed({word: f"{word}_{mark}" for word in words})
        for side, mark, sign in ((new, "x", ""), (old, "y", "-"))
    ]
    stacked = sides[0].unionByName(sides[1], allowMissingColumns=True)
    grouped = stacked.groupBy(*keys).agg(
        *_counts(),
        *[F.expr(f"sum(`d_{k}`) AS `d_{k}`") for k in kpis],
        *[F.bit_or(f"{word}_{mark}").alias(f"{word}_{mark}") for word in words for mark in "xy"],
    )

    selected = [*keys, *COUNTS]
    for w, start in enumerate(range(0, len(kpis), WORD)):
        every = F.lit((1 << len(kpis[start : start + WORD])) - 1).cast("bigint")
        numbers = _on_both(f"num_{w}")
        values = _on_both(f"set_{w}") if "set" in flags else numbers
        selected += [
            numbers.alias(f"num_{w}"),
            values.bitwiseXOR(every).alias(f"null_{w}"),
            values.bitwiseXOR(numbers).alias(f"fail_{w}"),
        ]
    return grouped.select(*selected, *[F.expr(f"`d_{k}` AS `diff_{k}`") for k in kpis])


def mismatch_words(kpis: Sequence[str], tol: float = TOLERANCE) -> list[Column]:
    """Bits ``err_`` of the KPIs that differ, over the columns of ``pair_differences``."""
    # As in ``exceeds``; a missing difference counts as none.
    far = pack_bits([f"NOT (abs(`diff_{k}`) <= {float(tol)!r}D)" for k in kpis], "err")
    return [
        word.bitwiseAND(F.col(f"num_{w}")).alias(f"err_{w}") for w, word in enumerate(far)
    ]


def words_of(flag: str, kpis: Sequence[str]) -> list[str]:
    return [f"{flag}_{w}" for w in range(-(-len(kpis) // WORD))]


def has_bit(flag: str, n: int) -> Column:
    """Whether a flag is set for the KPI at place ``n``."""
    return F.getbit(F.col(f"{flag}_{n // WORD}"), F.lit(n % WORD)) == 1


def is_matched() -> Column:
    return F.col(ENTITY).isNotNull() & (F.col("n_new") == 1) & (F.col("n_old") == 1)


def is_duplicated() -> Column:
    return F.col(ENTITY).isNotNull() & ((F.col("n_new") > 1) | (F.col("n_old") > 1))


def exceeds(difference: Column, tol: float = TOLERANCE) -> Column:
    """The difference is there and larger than ``tol``. The comparison is negated, not
    turned round, so that NaN counts as a mismatch.
    """
    return difference.isNotNull() & ~(F.abs(difference) <= F.lit(tol))


def _on_both(word: str) -> Column:
    return F.coalesce(F.col(f"{word}_x").bitwiseAND(F.col(f"{word}_y")), F.lit(0).cast("bigint"))


COUNTS = ["n_new", "n_old", "bad_new", "bad_old"]


def _counts() -> list[Column]:
    sources = ("in_x", "in_y", "bad_x", "bad_y")
    return [F.count(source).alias(name) for source, name in zip(sources, COUNTS)]


def entity_key(df: DataFrame) -> Column:
    """The entity key as bigint; null if it is no whole number. Fractions are not cut off."""
    return whole_number(df, ENTITY)


def _keys(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [entity_key(df).alias(k) if k == ENTITY else F.col(k) for k in keys]


def bad_key(df: DataFrame, keys: Sequence[str] = (ENTITY,)) -> Column:
    """1 for a key that is there but no whole number, else null. Facts of several tables tell
    it in a column."""
    if ENTITY in keys and BAD_KEY in df.columns:
        return F.col(BAD_KEY)
    if ENTITY not in keys or isinstance(df.schema[ENTITY].dataType, T.IntegralType):
        return F.lit(None).cast("int")
    return F.when(F.col(ENTITY).isNotNull() & entity_key(df).isNull(), 1)


def _number(kpi: str) -> Column:
    return F.col(kpi).try_cast("double")


def pack_bits(conditions: Sequence[str], name: str) -> list[Column]:
    """The conditions (SQL) as bits of as few bigint columns ``name_0``, ``name_1`` … as
    will do. One expression per column: built bit by bit, it would take longer to put
    together than to run.
    """
    words = []
    for start in range(0, len(conditions), WORD):
        bits = [f"IF({c}, {1 << n}L, 0L)" for n, c in enumerate(conditions[start : start + WORD])]
        # Halves of halves: a chain of sixty operators would be parsed and planned deep.
        while len(bits) > 1:
            bits = [" | ".join(bits[i : i + 2]) for i in range(0, len(bits), 2)]
            bits = [f"({b})" for b in bits]
        words.append(F.expr(f"{bits[0]} AS {name}_{start // WORD}"))
    return words
