"""The old side of a comparison, read from a database in parallel."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicecheck.functions.names import table_name
from slicecheck.operators.casting import typed_projection
from slicecheck.settings import ENTITY
from slicecheck.sources.tables import Tables


def jdbc_options(
    url: str,
    table: str,
    lower: int,
    upper: int,
    partitions: int,
    column: str = ENTITY,
    fetch_size: int = 10_000,
    **more: str,
) -> dict[str, str]:
    """Options of a parallel read. The bounds only set the strides: rows outside
    them fall into the first or last partition, none is lost.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        **more,
    }


def old_tables(
    spark: SparkSession,
    models: Iterable[tuple[str, str]],
    options: Callable[[str], dict[str, str]],
    first_day: int,
    last_day: int,
    read: Callable[[dict[str, str]], DataFrame] | None = None,
) -> Tables:
    """The old store's tables of some models for ``facts_of``, each read in parallel, with
    the range of days pushed into the database. ``options`` gives a table's, by name (see
    :func:`jdbc_options`). Names of columns may be in upper case.
    """
    load = read or (lambda own: spark.read.format("jdbc").options(**own).load())
    days = F.col("sd").between(first_day, last_day)
    return {(m, p.lower()): load(options(table_name(m, p))).where(days) for m, p in models}


def read_old_slice(
    spark: SparkSession,
    options: dict[str, str],
    start_day: int,
    start_time: int,
    kpis: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """One time slot of the old table; the filter is pushed into the database."""
    table = spark.read.format("jdbc").options(**options).load()
    slot = (F.col("sd") == start_day) & (F.col("st") == start_time)
    return typed_projection(table.where(slot), kpis, by)
