"""Ordered output and fixed-size batches.

Batch numbers need an exact rank within each slice, and a slice may hold a large share of
all rows. Slices of ordinary size are ranked by a window each. Large ones are cut first, at
bounds that a mergeable quantile sketch gives; the bounds are fixed values from then on, so
counts per piece give the offset of each piece, and ranks are taken inside pieces. Rows are
shuffled once, and only bounds and counts are written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicecheck.operators.casting import column_type
from slicecheck.settings import ENTITY, KEYS_PER_BATCH, written

# Rows that one task ranks, about.
PIECE_ROWS = 1_000_000
MOST_PIECES = 2000
# An input of so many bytes has no group that would need to be cut.
SMALL_BYTES = 16 << 20


def sorted_slice(df: DataFrame, entity: str = ENTITY) -> DataFrame:
    return df.orderBy(F.desc(entity))


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    copies: str | None = None,
    name: str = "pos",
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Adds the 0-based position of each row in the order of its ``by`` group. ``order`` are
    columns, with a minus in front for falling order; together they must be unique within a
    group. A row may stand for several equal ones: it then takes ``copies`` positions and
    ``name`` is the first of them. Groups above ``piece_rows`` are cut by the first order
    column if it is a number; rows that share its value stay together.
    """
    by, columns = list(by), df.columns
    if _bytes_of(df) <= SMALL_BYTES and piece_rows >= PIECE_ROWS:
        return _ranked(df, by, order, copies, name).select(*columns, name)
    first, falling = order[0].removeprefix("-"), order[0].startswith("-")
    sizes = df.groupBy(*by).agg(F.count("*").alias("_n"))
    # No more than MOST_PIECES groups, or pieces, can be that large: what is sent to all tasks.
    rows = sizes.agg(F.sum("_n")).first()[0] or 0
    limit = max(piece_rows, -(-rows // MOST_PIECES))
    large = written(sizes.where(F.col("_n") > limit))
    most = large.agg(F.max("_n")).first()[0]
    numeric = isinstance(column_type(df, first), T.NumericType)
    if most is None or not numeric:
        return _ranked(df, by, order, copies, name).select(*columns, name)

    named = {c: f"_of_{c}" for c in by}
    of_group = [F.col(c).eqNullSafe(F.col(o)) for c, o in named.items()]
    pieces = -(-most // limit)
    sketch = F.percentile_approx(first, [n / pieces for n in range(1, pieces)], 100 * pieces)
    big = large.withColumnsRenamed(named)
    # Groups smaller than the largest need fewer of the bounds.
    step = F.greatest(F.floor(F.lit(most) / F.col("_n")), F.lit(1))
    bounds = written(
        df.join(F.broadcast(big), of_group)
        .groupBy(*named.values(), "_n")
        .agg(sketch.alias("_all"))
        .select(*named.values(), F.filter("_all", lambda b, i: (i + 1) % step == 0).alias("_bounds"))
    )

    def behind(bound: Column) -> Column:
        return bound > F.col(first) if falling else bound < F.col(first)

    piece = F.size(F.filter("_bounds", behind))
    if falling:  # nulls come last
        piece = F.when(F.col(first).isNull(), F.size("_bounds")).otherwise(piece)
    cut = df.join(F.broadcast(bounds), of_group, "left")
    cut = cut.withColumn("_piece", F.when(F.col("_bounds").isNull(), 0).otherwise(piece)).select(*columns, "_piece")
    size = F.sum(copies) if copies else F.count("*")
    earlier = Window.partitionBy(*named.values()).orderBy("_of_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        cut.join(F.broadcast(big), of_group)
        .groupBy(*named.values(), F.col("_piece").alias("_of_piece"))
        .agg(size.alias("_size"))
        .withColumn("_start", F.sum("_size").over(earlier))
        .drop("_size")
    )
    ranked = _ranked(cut, [*by, "_piece"], order, copies, name)
    placed = ranked.join(F.broadcast(starts), [*of_group, F.col("_piece") == F.col("_of_piece")], "left")
    position = F.col(name) + F.coalesce(F.col("_start"), F.lit(0))
    return placed.select(*columns, position.cast("bigint").alias(name))


def _ranked(df: DataFrame, by: Sequence[str], order: Sequence[str], copies: str | None, name: str) -> DataFrame:
    sort = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]
    window = Window.partitionBy(*by).orderBy(*sort)
    if copies:
        before = F.sum(copies).over(window.rowsBetween(Window.unboundedPreceding, -1))
        position = F.coalesce(before, F.lit(0))
    else:
        position = F.row_number().over(window) - 1
    return df.withColumn(name, position.cast("bigint"))


def _bytes_of(df: DataFrame) -> int:
    """What the planner expects; of files, what they take on disk."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def key_batches(
    df: DataFrame, by: Sequence[str], size: int = KEYS_PER_BATCH, entity: str = ENTITY
) -> DataFrame:
    """The distinct keys of each slice with the number of their batch, largest keys first."""
    keys = df.select(*by, entity).where(F.col(entity).isNotNull()).distinct()
    numbered = number_rows(keys, by, [f"-{entity}"])
    return numbered.select(*by, entity, F.expr(f"pos div {size}").alias("batch"))
