"""What is wrong with single tables, found before a batch is planned, so that it fails the
tasks on these tables and no others.

Columns and types are known without reading rows: a table without a key or slot columns, or
with one of a type that holds no numbers, is left out, and a KPI of such a type is dropped
from its table. Days and times that are text or of a wide type are read once, two columns
wide; rows that belong to no slot that can be named might be of any, so they fail the model.
Unusable keys and values are found by the batch itself, slice by slice.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicecheck.operators.casting import whole_number
from slicecheck.settings import ENTITY
from slicecheck.sources.tables import Catalog, Tables, existing_names, own_kpis

SLOT_COLUMNS = ("sd", "st")
FAULT_SCHEMA = "motype string, period string, side string, place string, reason string, n bigint"
# Faults of a whole table; one of a KPI fails what checks the KPI.
TABLE_REASONS = ("unreadable", "no column", "ambiguous column", "no numbers", "no slot")
KPI_REASON = "kpi without numbers"


@dataclass(frozen=True)
class Copy:
    """The tables of one copy that can be used. ``listed`` has all KPIs of each, as tasks
    may name them, ``sound`` those that hold numbers."""

    side: str
    tables: Tables
    listed: Catalog
    sound: Catalog
    faults: list[tuple]


def inspect(tables: Tables, side: str) -> Copy:
    """Sorts out what cannot be compared, by columns and types alone."""
    usable, listed, sound, faults = {}, {}, {}, []
    for model, df in tables.items():

        def fault(place: str, reason: str) -> None:
            faults.append((*model, side, place, reason, None))  # noqa: B023

        names = Counter(c.lower() for c in df.columns)
        kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
        whole = len(faults)
        for c in (ENTITY, *SLOT_COLUMNS):
            if names[c] == 0:
                fault(c, "no column")
            elif names[c] > 1:
                fault(c, "ambiguous column")
            elif not _numbers(kinds[c]):
                fault(c, "no numbers")
        if len(faults) > whole:
            continue
        kpis = list(dict.fromkeys(own_kpis(df)))
        good = [k for k in kpis if names[k] == 1 and _numbers(kinds[k])]
        for k in kpis:
            if k not in good:
                fault(k, KPI_REASON)
        listed[model], sound[model] = kpis, good
        usable[model] = df.select(*SLOT_COLUMNS, ENTITY, *good)
    return Copy(side, usable, listed, sound, faults)


def read_copy(
    spark: SparkSession, models: Iterable[tuple[str, str]], side: str, database: str | None = None
) -> Copy:
    """A copy in the catalog. A table that is listed but cannot be opened is a fault; one
    that is not listed is none, its tasks fail as they have nothing to check."""
    tables, faults = {}, []
    for model, name in existing_names(spark, models, database).items():
        try:
            df = spark.table(name)
            df.schema  # noqa: B018  resolves the table
        except PySparkException as error:
            faults.append((*model, side, name, "unreadable", None))
            if not error.getCondition():
                raise
        else:
            tables[model] = df
    copy = inspect(tables, side)
    return Copy(side, copy.tables, copy.listed, copy.sound, [*faults, *copy.faults])


def fault_rows(spark: SparkSession, copies: Iterable[Copy]) -> DataFrame:
    """All faults as rows: model, period, side, the column (or table), the reason, and for
    unreadable slots the number of rows."""
    copies = list(copies)
    known = spark.createDataFrame([f for c in copies for f in c.faults], FAULT_SCHEMA)
    return reduce(DataFrame.unionAll, [_unplaced(c, m) for c in copies for m in c.tables if _loose(c.tables[m])], known)


def failed_models(faults: DataFrame) -> DataFrame:
    """The (model, period) whose every slice has failed."""
    return faults.where(F.col("reason").isin(*TABLE_REASONS)).select("motype", "period").distinct()


def held_kpis(new: Copy, old: Copy) -> Catalog:
    """The KPIs that can be compared, of the models that both copies have."""
    return {
        model: [k for k in kpis if k in new.sound.get(model, [])] for model, kpis in old.sound.items()
    }


def _numbers(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.StringType))


def _loose(df: DataFrame) -> list[str]:
    """Slot columns that may hold what is no slot."""
    narrow = (T.ByteType, T.ShortType, T.IntegerType)
    return [c for c in SLOT_COLUMNS if not isinstance(df.schema[c].dataType, narrow)]


def _unplaced(copy: Copy, model: tuple[str, str]) -> DataFrame:
    df = copy.tables[model]
    lost = [F.col(c).isNotNull() & whole_number(df, c, "int").isNull() for c in _loose(df)]
    counted = df.where(reduce(lambda a, b: a | b, lost)).agg(F.count("*").alias("n"))
    lits = [F.lit(v).alias(n) for v, n in zip((*model, copy.side, "sd, st", "no slot"), FAULT_SCHEMA.split()[::2])]
    return counted.where("n > 0").select(*lits, "n")
