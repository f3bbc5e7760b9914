"""Two copies of KPI tables, tasks and metadata, derived from the given tables.

Old copies differ from the new ones in planned places: some keys are missing and
some values are shifted, by rules on the key. The rules are part of the data, they
are not there to make it smaller. ``checks/fixture_sql.py`` holds the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicecheck.functions.models import LOGICAL_MODEL_IDS
from slicecheck.functions.text import day_int

ORDER_KPIS = ["i1", "i2", "i3", "i4"]
EVENT_KPIS = ["i1", "i2", "i3"]
EXPORT_COLUMNS = ["mo", "name", "sd", "st", "r1", "n745", "a9", "isonsite", "remark", "other"]
LIST_WIDTH = 500
MODEL_WIDTH = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Orders: one slice of entities, KPIs from the order and its lines.


def orders_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("i2"),
            F.max("l_extendedprice").alias("i3"),
            F.count("*").cast("double").alias("i4"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    # Dealt by key whatever the sizes are: with only the key read, the order table looks
    # small enough to be sent whole to every task, and it grows with the input.
    return orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("mo"), F.col("o_totalprice").alias("i1"), *ORDER_KPIS[1:]
    )


def orders_old(spark: SparkSession, sf_dir: str, shift_every: int = 97) -> DataFrame:
    mo = F.col("mo")
    shifted = (mo % shift_every == 0) | (mo % 97 == 0)
    return (
        orders_new(spark, sf_dir)
        .where(mo % 50 != 0)
        .select(
            "mo",
            F.when(shifted, F.col("i1") + 1.0)
            .when(mo % 89 == 0, F.col("i1") + 0.005)
            .otherwise(F.col("i1"))
            .alias("i1"),
            F.when(mo % 83 != 0, F.col("i2")).alias("i2"),
            F.when(mo % 101 == 0, F.col("i3") * 1.1).otherwise(F.col("i3")).alias("i3"),
            "i4",
        )
    )


def orders_old_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_old(spark, sf_dir, shift_every=10)


def orders_old_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_old(spark, sf_dir).withColumn("mo", -1 - F.col("mo"))


def orders_old_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = orders_old(spark, sf_dir)
    return old.unionAll(old.where(F.col("mo") % 1000 == 1))


def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order table as an old store may deliver it: keys, counts as text, gaps and junk."""
    mo = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(mo % 211 == 0, "null").otherwise(mo.cast("string")).alias("mo"),
        F.col("o_custkey").cast("string").alias("i1"),
        F.when(mo % 97 == 0, "n/a").when(mo % 89 != 0, F.col("o_custkey").cast("string")).alias("i2"),
        F.when(mo % 83 == 0, F.col("o_orderpriority"))
        .otherwise(F.floor("o_totalprice").cast("string"))
        .alias("i3"),
        F.length("o_orderpriority").alias("i4"),
        F.col("o_orderstatus").alias("name"),
    )


def supplies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by supplier and day, of which one supplier has about a third and some have no key."""
    part = F.when(F.col("l_linenumber") != 7, F.when(F.col("l_linenumber") % 3 == 1, 1).otherwise(F.col("l_suppkey")))
    return table(spark, sf_dir, "lineitem").select(
        part.cast("bigint").alias("mo"),
        day_int(F.col("l_shipdate").cast("timestamp")).alias("sd"),
        F.col("l_quantity").alias("i1"),
    )


# Events: many slices, one per hour.


def events_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    def seen(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind).cast("double")

    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.lit("events").alias("motype"),
            F.lit("h").alias("period"),
            day_int(F.col("ts")).alias("sd"),
            F.hour("ts").alias("st"),
            F.col("user_id").alias("mo"),
        )
        .agg(seen("click").alias("i1"), seen("view").alias("i2"), F.max("value").alias("i3"))
    )


def events_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("st") == 7, F.col("i3") + 1).otherwise(F.col("i3"))
    return (
        events_new(spark, sf_dir)
        .where(~((F.col("sd") == 20240105) & (F.col("st") == 3)))
        .withColumn("i3", shifted)
    )


def event_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks for every hour with events, with and without KPI and entity lists; a
    second task for every sixth hour; one task per day for an hour that has no data.
    """
    ts = F.col("ts")
    hours = (
        table(spark, sf_dir, "events")
        .select(day_int(ts).alias("start_day"), F.hour(ts).alias("start_time"))
        .distinct()
    )
    st = F.col("start_time")
    entities = F.concat_ws(",", st, st + 24, st + 48, F.col("start_day") % 100, F.lit("x"))
    first = hours.select(
        (F.col("start_day").cast("bigint") * 100 + st).alias("task_id"),
        F.lit("events").alias("motype"),
        F.lit("H").alias("period"),
        "start_day",
        "start_time",
        F.when(st == 11, "i1,i9")
        .when(st == 13, "i2,,")
        .when(st == 14, ",")
        .when(st == 15, "mo, I3")
        .when(st % 4 == 1, "i1,i3")
        .when(st % 4 == 3, "i3,i2,i1")
        .alias("indicators"),
        F.when((st % 8 == 7) & (F.col("start_day") % 2 == 0), entities).alias("moentities"),
    )
    second = first.where(st % 6 == 0).select(
        (F.col("task_id") + 10_000_000_000).alias("task_id"),
        *["motype", "period", "start_day", "start_time"],
        F.lit("i2").alias("indicators"),
        F.lit(None).cast("string").alias("moentities"),
    )
    idle = (
        first.select("start_day")
        .distinct()
        .select(
            (F.col("start_day").cast("bigint") * 100 + 24).alias("task_id"),
            F.lit("events").alias("motype"),
            F.lit("h").alias("period"),
            "start_day",
            F.lit(24).alias("start_time"),
            F.lit(None).cast("string").alias("indicators"),
            F.lit(None).cast("string").alias("moentities"),
        )
    )
    return first.unionAll(second).unionAll(idle)


def two_models(spark: SparkSession, sf_dir: str):
    """Tasks, and the new and old tables of two models: orders by month (KPIs i1, i2, i9)
    and events by hour. The old tables have upper-case names; that of orders has every
    tenth key missing, a shifted i1 for some, and no i9. Only tasks on slot 0 of orders
    check i9.
    """
    orders = export_rows(spark, sf_dir).select(
        "sd",
        "st",
        "mo",
        F.col("r1").cast("double").alias("i1"),
        (F.col("mo") % 17).cast("double").alias("i2"),
        F.lit(1.0).alias("i9"),
    )
    kept = orders.where(F.col("mo") % 10 != 0)
    shifted = F.when(F.col("mo") % 100 == 7, F.col("i1") + 1).otherwise(F.col("i1"))
    old_orders = kept.withColumn("i1", shifted).drop("i9")
    events = ["sd", "st", "mo", *EVENT_KPIS]

    def upper(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(c.upper()) for c in df.columns])

    old_events = events_new(spark, sf_dir).withColumn(
        "i3", F.when(F.col("st") == 7, F.col("i3") + 1).otherwise(F.col("i3"))
    )
    new = {("orders", "m"): orders, ("events", "h"): events_new(spark, sf_dir).select(*events)}
    old = {("orders", "m"): upper(old_orders), ("events", "h"): upper(old_events.select(*events))}
    slots = [
        df.select("sd", "st").distinct().withColumn("motype", F.lit(m)).withColumn("period", F.lit(p))
        for (m, p), df in new.items()
    ]
    lists = F.when((F.col("motype") == "orders") & (F.col("st") == 1), "i1,i2")
    tasks = (
        slots[0].unionByName(slots[1])
        .select(
            F.xxhash64("motype", "sd", "st").alias("task_id"),
            "motype",
            "period",
            F.col("sd").alias("start_day"),
            F.col("st").alias("start_time"),
            lists.alias("indicators"),
            F.lit(None).cast("string").alias("moentities"),
        )
    )
    return tasks, new, old


def faulty_models(spark: SparkSession, sf_dir: str):
    """Tasks, and both copies of five models: events, which are sound, and orders by month
    without a key in the new copy, with a date for a KPI and with days as text, some of them
    unreadable, in the old one, and with keys as doubles, some of them NaN.
    """
    mo = F.col("mo")
    orders = export_rows(spark, sf_dir).select(
        "sd", "st", "mo", F.col("r1").cast("double").alias("i1"), (mo % 17).cast("double").alias("i2")
    )
    events = events_new(spark, sf_dir).select("sd", "st", "mo", *EVENT_KPIS)
    same = {(m, "m"): orders for m in ("nokey", "datekpi", "textday", "nankey")} | {("sound", "h"): events}
    new, old = dict(same), dict(same)
    new["nokey", "m"] = orders.withColumnRenamed("mo", "entity")
    old["datekpi", "m"] = orders.withColumn("i1", F.lit("2024-01-01").cast("date"))
    day = F.when(mo % 101 == 0, "n/a").otherwise(F.col("sd").cast("string"))
    old["textday", "m"] = orders.withColumn("sd", day)
    old["nankey", "m"] = orders.withColumn("mo", F.when(mo % 500 == 0, float("nan")).otherwise(mo.cast("double")))
    slots = orders.select("sd", "st").distinct()
    named = F.explode(F.array(*[F.lit(m) for m, p in same if p == "m"])).alias("motype")
    slots = slots.select("sd", "st", named, F.lit("m").alias("period")).unionAll(
        events.select("sd", "st", F.lit("sound").alias("motype"), F.lit("h").alias("period")).distinct()
    )
    tasks = slots.select(
        F.xxhash64("motype", "sd", "st").alias("task_id"),
        "motype",
        "period",
        F.col("sd").alias("start_day"),
        F.col("st").alias("start_time"),
        F.when((F.col("motype") == "datekpi") & (F.col("st") == 0), "i2").alias("indicators"),
        F.lit(None).cast("string").alias("moentities"),
    )
    return tasks, new, old


# Key/value metadata: nations as models, customers as objects.


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model per nation and block of customers."""
    return table(spark, sf_dir, "customer").select(_model().alias("motype")).distinct()


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    model_ids = models(spark, sf_dir).select("motype", F.split("motype", "_").alias("part"))
    nation, block = F.col("part")[0], F.col("part")[1]
    nations = table(spark, sf_dir, "nation").withColumn("n", F.col("n_nationkey").cast("string"))
    named = model_ids.join(nations, nation == F.col("n")).where("n_nationkey % 5 <> 4")
    key = F.col("c_custkey")
    objects = customers.select(
        F.concat(F.lit("OBJ:S"), _model(), F.lit(":"), key).alias("key"),
        F.inline(
            F.array(
                _entry("NAME", F.col("c_name")),
                _entry("SEGMENT", F.col("c_mktsegment")),
                # Some customers share an entity, some have none, some lack the field.
                _entry(
                    "MO",
                    F.when(key % 31 == 0, "null")
                    .when(key % 37 == 0, "NULL")
                    .when(key % 3 == 0, (key - key % 600).cast("string"))
                    .when(key % 41 != 0, key.cast("string")),
                ),
            )
        ),
    ).where(F.col("value").isNotNull())
    return (
        _hash(model_ids, "MOTYPE:MOTYPEID:SEQUENCE", F.col("motype"), F.concat(F.lit("S"), "motype"))
        .unionAll(_hash(named, "ALLMODELMAPPING", F.col("motype"), F.concat("n_name", F.lit("/"), block)))
        .unionAll(
            _hash(
                table(spark, sf_dir, "part"),
                "ALLINDICATORID2SEQ:CONF",
                F.concat(F.lit("IND"), "p_partkey"),
                F.col("p_partkey").cast("string"),
            )
        )
        .unionAll(objects)
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lists: object lists of at most LIST_WIDTH ids, lists of lists, and columns."""
    lists = (
        table(spark, sf_dir, "customer")
        .groupBy(_model().alias("motype"), F.expr(f"c_custkey div {LIST_WIDTH}").alias("n"))
        .agg(F.array_sort(F.collect_list("c_custkey")).alias("ids"))
        .withColumn("list_key", F.concat(F.lit("LIST:"), "motype", F.lit(":"), "n"))
    )
    of_lists = lists.groupBy("motype").agg(F.array_sort(F.collect_list("n")).alias("ns"))
    list_keys = F.transform("ns", lambda n: F.concat(F.lit("LIST:"), "motype", F.lit(":"), n))
    columns = models(spark, sf_dir).where(~F.col("motype").startswith("3_"))
    return (
        lists.select(F.col("list_key").alias("key"), F.array_join("ids", ",").alias("value"))
        .unionAll(
            of_lists.select(
                F.concat(F.lit("MOTYPE:OBJ:LIST:"), "motype").alias("key"),
                # A list that does not exist is named, too.
                F.concat(F.array_join(list_keys, ","), F.lit(",LIST:none,")).alias("value"),
            )
        )
        .unionAll(
            columns.select(
                F.concat(F.lit("MOTYPE:CONFIG:"), "motype").alias("key"),
                F.concat(F.lit("mo,sd,st,i"), "motype", F.lit(",,")).alias("value"),
            )
        )
    )


def part_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model id for every part; about every second one is a logical model."""
    n = len(LOGICAL_MODEL_IDS)
    ids = F.array(*[F.lit(i) for i in LOGICAL_MODEL_IDS])
    place = (F.col("p_partkey") % (2 * n) + 1).cast("int")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"),
        F.when(place <= n, F.get(ids, place - 1))
        .when(place < 2 * n, F.md5(F.col("p_partkey").cast("string")))
        .alias("motype"),
    )


# Names, lists and export rows.


def column_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table and column names as a catalog would list them, from parts."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.lower("p_brand").alias("table_name"),
        F.when(key % 9 == 0, F.concat(F.lit("k"), key))
        .when(key % 9 == 1, F.concat(F.lit("I"), key))
        .when(key % 9 == 2, F.concat(F.lit("i"), key, F.lit("a")))
        .when(key % 9 == 3, F.concat(F.lit("i_"), key))
        .when(key % 9 == 4, F.when(key % 2 == 0, "mo").otherwise("MO"))
        .otherwise(F.concat(F.lit("i"), key))
        .alias("column_name"),
        key.alias("column_no"),
    )


def text_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lists with inner and trailing gaps, from orders."""
    key = F.col("o_orderkey")
    gaps = F.repeat(F.lit(","), (key % 4).cast("int"))
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        F.when(key % 11 == 0, gaps)
        .when(key % 13 != 0, F.concat("o_orderstatus", gaps, F.lit(", "), "o_orderpriority", gaps))
        .alias("items"),
    )


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under names of every class of exported columns; one slice per month."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("motype"),
        F.lit("m").alias("period"),
        (F.year(day) * 100 + F.month(day)).cast("int").alias("sd"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("st"),
        key.alias("mo"),
        F.when(key % 7 != 0, F.concat(F.lit("order "), key)).alias("name"),
        F.when(key % 5 != 0, F.col("o_custkey").cast("int")).alias("r1"),
        F.when(key % 3 != 0, F.col("o_orderpriority")).alias("n745"),
        F.col("o_orderstatus").alias("a9"),
        F.when(key % 11 != 0, F.col("o_orderstatus")).alias("isonsite"),
        F.col("o_custkey").cast("int").alias("remark"),
        F.col("o_orderstatus").alias("other"),
    )



def _model() -> Column:
    block = F.expr(f"c_custkey div {MODEL_WIDTH}")
    return F.concat_ws("_", F.col("c_nationkey"), block)


def _entry(field: str, value: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), value.alias("value"))


def _hash(df: DataFrame, key: str, field: Column, value: Column) -> DataFrame:
    return df.select(F.lit(key).alias("key"), field.alias("field"), value.alias("value"))
