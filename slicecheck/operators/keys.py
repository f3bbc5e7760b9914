"""Key sets of two copies: what is on both sides, on one, or there more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicecheck.operators.pairs import is_duplicated, pair_rows
from slicecheck.settings import ENTITY


def key_counts(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with its number of rows on each side."""
    return pair_rows(new, old, keys, [])


def key_intersection(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found on both sides; ``copies`` tells how often the new side lists each."""
    return _present(new, old, keys, "n_new > 0 and n_old > 0", "n_new")


def keys_only_new(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _present(new, old, keys, "n_old = 0", "n_new")


def keys_only_old(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _present(new, old, keys, "n_new = 0", "n_old")


def duplicate_keys(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    return key_counts(new, old, keys).where(is_duplicated()).drop("bad_new", "bad_old")


def side_counts(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row and key counts of both sides, per slice if there are keys before the entity.
    Keys that are there but no whole numbers are counted apart from null ones."""
    known = F.col(ENTITY).isNotNull()
    in_new, in_old = F.col("n_new") > 0, F.col("n_old") > 0
    by = [k for k in keys if k != ENTITY]
    return (
        key_counts(new, old, keys)
        .groupBy(*by)
        .agg(
            *[
                F.coalesce(total, F.lit(0)).cast("bigint").alias(name)
                for name, total in {
                    "new_rows": F.sum("n_new"),
                    "old_rows": F.sum("n_old"),
                    "new_null_keys": F.sum(F.when(~known, F.col("n_new") - F.col("bad_new"))),
                    "old_null_keys": F.sum(F.when(~known, F.col("n_old") - F.col("bad_old"))),
                    "new_bad_keys": F.sum("bad_new"),
                    "old_bad_keys": F.sum("bad_old"),
                    "matched_keys": F.count_if(known & in_new & in_old),
                    "only_new_keys": F.count_if(known & in_new & ~in_old),
                    "only_old_keys": F.count_if(known & in_old & ~in_new),
                }.items()
            ]
        )
    )


def restrict_entities(rows: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is listed."""
    return rows.join(listed.select(*keys).distinct(), list(keys), "left_semi")


def _present(
    new: DataFrame, old: DataFrame, keys: Sequence[str], condition: str, copies: str
) -> DataFrame:
    found = key_counts(new, old, keys).where(F.col(ENTITY).isNotNull() & F.expr(condition))
    return found.select(*keys, F.col(copies).alias("copies"))
