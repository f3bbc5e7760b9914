"""Typed projection and values that do not convert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicecheck.settings import ENTITY


def column_type(df: DataFrame, column: str) -> T.DataType:
    """By name, in upper or lower case."""
    return next(f.dataType for f in df.schema.fields if f.name.lower() == column.lower())


def whole_number(df: DataFrame, column: str, kind: str = "bigint") -> Column:
    """A column as whole numbers; null where it is none. Fractions are not cut off."""
    value = F.col(column)
    if isinstance(column_type(df, column), (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.when(value == F.floor(value), value.try_cast(kind))
    return value.try_cast(kind)


def typed_projection(
    df: DataFrame, kpis: Sequence[str], by: Sequence[str] = (), entity: str = ENTITY
) -> DataFrame:
    """``by`` columns, the entity key as bigint and the KPIs as double; nothing else.
    A value that does not convert becomes null: see :func:`cast_failures`. So does a key that
    is no whole number, as everywhere.
    """
    return df.select(
        *by,
        whole_number(df, entity).alias(entity),
        *[F.col(k).try_cast("double").alias(k) for k in kpis],
    )


def not_castable(column: Column, to: str) -> Column:
    return column.isNotNull() & column.try_cast(to).isNull()


def cast_failures(df: DataFrame, kpis: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Number of values per KPI (and per ``by``) that are no numbers."""
    counts = df.groupBy(*by).agg(
        *[F.count_if(not_castable(F.col(k), "double")).alias(k) for k in kpis]
    )
    return long_counts(counts, kpis, by)


def long_counts(counts: DataFrame, kpis: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per KPI out of one count column per KPI."""
    entries = [F.struct(F.lit(k).alias("kpi"), F.col(k).cast("bigint").alias("n")) for k in kpis]
    return counts.select(*by, F.inline(F.array(*entries)))
