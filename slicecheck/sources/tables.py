"""KPI tables of the catalog, one per model and granularity."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicecheck.functions.names import kpi_columns, table_name
from slicecheck.operators.casting import whole_number
from slicecheck.settings import BAD_KEY, ENTITY

# (model, period) to the KPIs of its table, in their order.
Catalog = dict[tuple[str, str], list[str]]
# (model, period) to its table.
Tables = dict[tuple[str, str], DataFrame]


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def qualified_name(motype: str, period: str, database: str | None = None) -> str:
    name = table_name(motype, period)
    return f"{database}.{name}" if database else name


def kpi_table(
    spark: SparkSession, motype: str, period: str, database: str | None = None
) -> DataFrame:
    return spark.table(qualified_name(motype, period, database))


def own_kpis(df: DataFrame) -> list[str]:
    """KPI columns of a table under their usual names. Spark does not tell upper case from
    lower in names, and databases often give upper case, so neither do we."""
    return kpi_columns([c.lower() for c in df.columns])


def table_kpis(
    spark: SparkSession, motype: str, period: str, database: str | None = None
) -> list[str] | None:
    """KPI columns of a catalog table, None if there is no such table."""
    if not spark.catalog.tableExists(qualified_name(motype, period, database)):
        return None
    return own_kpis(kpi_table(spark, motype, period, database))


def slice_scan(df: DataFrame, start_day: int, start_time: int, kpis: Sequence[str]) -> DataFrame:
    """Entity key and KPIs of one time slot. Both filters and the column list reach
    the scan; on tables partitioned by day only that day's files are opened.
    """
    slot = (F.col("sd") == start_day) & (F.col("st") == start_time)
    return df.where(slot).select(ENTITY, *kpis)


def task_models(tasks: DataFrame) -> list[tuple[str, str]]:
    """The (model, period) that tasks name: no other table needs to be read. One row per
    model reaches the driver."""
    named = tasks.select("motype", F.lower("period").alias("period")).distinct()
    return sorted((r.motype, r.period) for r in named.dropna().collect())


def existing_names(
    spark: SparkSession, models: Iterable[tuple[str, str]], database: str | None = None
) -> dict[tuple[str, str], str]:
    """Names of the tables of (model, period) that the catalog lists; it is asked once, for
    however many models."""
    if database and not spark.catalog.databaseExists(database):
        return {}
    listed = spark.catalog.listTables(database)
    there = {t.name.lower() for t in listed if not (database and t.isTemporary)}
    return {
        (m, p.lower()): qualified_name(m, p, database) for m, p in models if table_name(m, p).lower() in there
    }


def model_tables(
    spark: SparkSession, models: Iterable[tuple[str, str]], database: str | None = None
) -> Tables:
    """The tables of (model, period) that the catalog has."""
    return {model: spark.table(name) for model, name in existing_names(spark, models, database).items()}


def catalog_of(tables: Tables) -> Catalog:
    return {model: own_kpis(df) for model, df in tables.items()}


def model_catalog(
    spark: SparkSession, models: Iterable[tuple[str, str]], database: str | None = None
) -> Catalog:
    """The KPIs of each (model, period); one without a table is left out."""
    return catalog_of(model_tables(spark, models, database))


def value_columns(catalog: Catalog) -> list[str]:
    return [f"v{n + 1}" for n in range(max(map(len, catalog.values()), default=0))]


def load_models(spark: SparkSession, catalog: Catalog, database: str | None = None) -> DataFrame:
    """The tables of a catalog as one fact table, see :func:`facts_of`."""
    return facts_of(spark, model_tables(spark, catalog, database), catalog)


def facts_of(spark: SparkSession, tables: Tables, catalog: Catalog) -> DataFrame:
    """Tables of models as one fact table ``SLICE, mo`` and value columns.

    Models have different KPIs, often without any in common. Each model's first KPI
    is put into ``v1`` and so on, so that the table is as wide as the widest model
    and not as all KPIs together. Both copies must be laid out by one catalog, that of
    the new copy. A KPI that this copy lacks is null, and a model without a table here has
    no rows: hand the old copy's own catalog to the batch, which fails such slices.
    Values keep their types, so that what is no number is noticed there. Keys are bigint, each
    converted as its own table has it, and ``BAD_KEY`` marks those that are no whole numbers.
    A day or time that is no number is null; ``sources.quarantine`` finds such tables.
    """
    columns = value_columns(catalog)
    kinds = _value_types(tables, catalog, columns)
    facts = []
    for model, kpis in catalog.items():
        if model not in tables:
            continue
        df = tables[model]
        present = own_kpis(df)
        values = [F.col(k) if k in present else F.lit(None) for k in kpis]
        values += [F.lit(None)] * (len(columns) - len(kpis))
        key = whole_number(df, ENTITY)
        facts.append(
            df.select(
                F.lit(model[0]).alias("motype"),
                F.lit(model[1]).alias("period"),
                whole_number(df, "sd", "int").alias("sd"),
                whole_number(df, "st", "int").alias("st"),
                key.alias(ENTITY),
                F.when(F.col(ENTITY).isNotNull() & key.isNull(), 1).alias(BAD_KEY),
                *[value.cast(kinds[c]).alias(c) for value, c in zip(values, columns)],
            )
        )
    return reduce(DataFrame.unionAll, facts) if facts else _no_facts(spark, columns)


def _value_types(tables: Tables, catalog: Catalog, columns: Sequence[str]) -> dict[str, str]:
    """Text where some model keeps text in that place, else double."""
    text = dict.fromkeys(columns, False)
    for model, kpis in catalog.items():
        if model in tables:
            fields = {f.name.lower(): f.dataType for f in tables[model].schema.fields}
            for k, c in zip(kpis, columns):
                text[c] |= isinstance(fields.get(k), T.StringType)
    return {c: "string" if is_text else "double" for c, is_text in text.items()}


def named_view(df: DataFrame, purpose: str) -> str:
    """Registers ``df`` for SQL under a name of its own, so that checks running in
    one session cannot take each other's views.
    """
    name = f"{purpose}_{uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def _no_facts(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    schema = f"motype string, period string, sd int, st int, {ENTITY} bigint, {BAD_KEY} int"
    return spark.createDataFrame([], ", ".join([schema, *[f"{c} double" for c in columns]]))
