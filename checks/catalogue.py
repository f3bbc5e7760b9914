"""Every registered query, with the SQL that must give the same rows.

All queries run over the whole given tables. Lists are returned as rows or text,
so that both engines yield plain values.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.fixture_sql import with_views
from slicecheck.functions.names import catalog_columns
from slicecheck.functions.text import split_list, stamp_long
from slicecheck.operators import batches, compare, keys, lookup, members
from slicecheck.operators.casting import cast_failures, typed_projection
from slicecheck.operators.digests import digest_row_diff
from slicecheck.operators.prefilter import restrict_to_listed
from slicecheck.plans import tasks as task_plans
from slicecheck.plans.batch import KEY_COUNTS, Batch, reconcile_batch, reconcile_tables
from slicecheck.plans.summary import report_details, summarize
from slicecheck.settings import IDS_PER_CHUNK, SLICE, ensure_checkpoint_dir, written
from slicecheck.sinks import packed
from slicecheck.sinks.store import read_blob_lines, save_blobs
from slicecheck.sources import keyed
from slicecheck.sources.quarantine import fault_rows, inspect
from slicecheck.sources.strides import read_strides, stride_predicates
from slicecheck.sources.tables import catalog_of, facts_of, kpi_table, named_view, slice_scan, table_kpis, value_columns
from slicecheck.sources.tasks import pending_tasks, read_models, read_tasks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

KEY = ["mo"]
KPIS = fx.ORDER_KPIS
EVENT_KEY = [*SLICE, "mo"]
SLOT = (20240110, 9)
STAMP = "2024-02-01 03:04:05"
STAMP_LONG = 20240201030405


def query(sql: str | None = None, views: list[str] = ()) -> Callable[[Query], Query]:
    """Registers a query under the name of its function."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = with_views(list(views), sql) if views else sql
        return run

    return register


# Counts and verdict of one slice.


def _summary_sql(old: str) -> str:
    errors = " + ".join(
        f"count(*) FILTER (x_{k} IS NOT NULL AND y_{k} IS NOT NULL AND NOT abs(x_{k} - y_{k}) <= 0.01)"
        for k in KPIS
    )
    return f"""
        SELECT all_n, all_n - error_n AS right_n, error_n, rate,
               CAST(CASE WHEN all_n = 0 OR duplicated > 0 THEN 2 WHEN rate > 0.99 THEN 1
                         ELSE -1 END AS INTEGER) AS status
        FROM (SELECT *, CASE WHEN all_n > 0 THEN
                     CAST(all_n - error_n AS DOUBLE) / CAST(all_n AS DOUBLE) END AS rate
              FROM (SELECT count(*) * {len(KPIS)} AS all_n, {errors} AS error_n,
                           (SELECT count(*) FROM (SELECT mo FROM {old} GROUP BY mo
                                                  HAVING count(*) > 1)) AS duplicated
                    FROM pairs_{old}))"""


def _summary(spark: SparkSession, sf_dir: str, old: Callable) -> DataFrame:
    cmp = compare.compare_wide(fx.orders_new(spark, sf_dir), old(spark, sf_dir), KEY, KPIS)
    return summarize(cmp, [], len(KPIS))


@query(_summary_sql("orders_old"), ["pairs_orders_old"])
def recon_summary(spark, sf_dir):
    return _summary(spark, sf_dir, fx.orders_old)


@query(_summary_sql("orders_old_fail"), ["pairs_orders_old_fail"])
def recon_summary_fail(spark, sf_dir):
    return _summary(spark, sf_dir, fx.orders_old_fail)


@query(_summary_sql("orders_old_empty"), ["pairs_orders_old_empty"])
def recon_summary_empty(spark, sf_dir):
    return _summary(spark, sf_dir, fx.orders_old_empty)


@query(_summary_sql("orders_old_dup"), ["pairs_orders_old_dup"])
def recon_summary_dup(spark, sf_dir):
    return _summary(spark, sf_dir, fx.orders_old_dup)


# Scans, projections and names.


@query(f"SELECT mo, i1, i2, i3 FROM events_new WHERE sd = {SLOT[0]} AND st = {SLOT[1]}", ["events_new"])
def slice_scan_query(spark, sf_dir):
    return slice_scan(fx.events_new(spark, sf_dir), *SLOT, fx.EVENT_KPIS)


@query(
    f"SELECT mo, i1, i2, i3 FROM events_new WHERE sd = {SLOT[0]} AND st = {SLOT[1]} ORDER BY mo DESC",
    ["events_new"],
)
def sorted_slice(spark, sf_dir):
    return batches.sorted_slice(slice_scan(fx.events_new(spark, sf_dir), *SLOT, fx.EVENT_KPIS))


@query(
    """SELECT TRY_CAST(mo AS BIGINT) AS mo, TRY_CAST(i1 AS DOUBLE) AS i1,
              TRY_CAST(i2 AS DOUBLE) AS i2, TRY_CAST(i3 AS DOUBLE) AS i3,
              CAST(i4 AS DOUBLE) AS i4 FROM orders_text""",
    ["orders_text"],
)
def typed_projection_query(spark, sf_dir):
    return typed_projection(fx.orders_text(spark, sf_dir), KPIS)


@query(
    " UNION ALL ".join(
        f"""SELECT '{k}' AS kpi, count(*) FILTER (
                {k} IS NOT NULL AND TRY_CAST({k} AS DOUBLE) IS NULL) AS n FROM orders_text"""
        for k in KPIS
    ),
    ["orders_text"],
)
def coerce_failures(spark, sf_dir):
    return cast_failures(fx.orders_text(spark, sf_dir), KPIS)


@query(
    """SELECT table_name, column_name, column_no FROM column_listing
       WHERE regexp_matches(column_name, '^i[0-9]+$') OR lower(column_name) = 'mo'""",
    ["column_listing"],
)
def kpi_catalog(spark, sf_dir):
    return fx.column_listing(spark, sf_dir).where(catalog_columns(F.col("column_name")))


@query(
    """SELECT task_id, CAST(no - 1 AS INTEGER) AS pos, label AS kpi FROM (
           SELECT task_id, label,
                  row_number() OVER (PARTITION BY task_id ORDER BY no) AS no
           FROM (SELECT task_id, unnest(labels) AS label, generate_subscripts(labels, 1) AS no
                 FROM (SELECT *, CASE WHEN indicators IS NULL THEN ['i1', 'i2', 'i3']
                                      WHEN regexp_matches(indicators, '^,+$') THEN []
                                      ELSE string_split(regexp_replace(indicators, ',+$', ''), ',')
                                 END AS labels FROM event_tasks))
           WHERE lower(trim(label)) <> 'mo')""",
    ["event_tasks"],
)
def task_kpi_list(spark, sf_dir):
    return task_plans.task_kpi_list(fx.event_tasks(spark, sf_dir), fx.EVENT_KPIS)


@query(
    """SELECT id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS pos, unnest(parts) AS item
       FROM (SELECT id, string_split(regexp_replace(items, ',+$', ''), ',') AS parts
             FROM text_lists WHERE NOT regexp_matches(items, '^,+$'))""",
    ["text_lists"],
)
def split_list_query(spark, sf_dir):
    lists = fx.text_lists(spark, sf_dir)
    return lists.select("id", F.posexplode(split_list(F.col("items"))).alias("pos", "item"))


@query("SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS stamp FROM events")
def stamp_long_query(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    return events.select("event_id", stamp_long(F.col("ts")).alias("stamp"))


# Keys.


@query(
    """SELECT mo, count(*) AS n, sum(i1) AS i1, min(sd) AS first_day, max(sd) AS last_day FROM (
        SELECT CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber % 3 = 1 THEN 1 ELSE l_suppkey END AS mo,
            CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS sd, l_quantity AS i1 FROM lineitem
    ) GROUP BY mo"""
)
def old_store_strides(spark, sf_dir):
    """A table with a hot key, read in ranges of about equally many rows."""
    rows = fx.supplies(spark, sf_dir)
    old = read_strides(spark, "", "supplies", stride_predicates(rows, 16), read=rows.where)
    return old.groupBy("mo").agg(
        F.count("*").alias("n"),
        F.sum("i1").alias("i1"),
        F.min("sd").alias("first_day"),
        F.max("sd").alias("last_day"),
    )


@query(
    """SELECT mo, count(*) AS copies FROM orders_new
       WHERE mo IN (SELECT mo FROM orders_old) GROUP BY mo""",
    ["orders_new", "orders_old"],
)
def key_intersection(spark, sf_dir):
    return keys.key_intersection(fx.orders_new(spark, sf_dir), fx.orders_old(spark, sf_dir), KEY)


@query(
    """SELECT mo, count(*) AS copies FROM orders_new n
       WHERE NOT EXISTS (SELECT 1 FROM orders_old o WHERE o.mo = n.mo) GROUP BY mo""",
    ["orders_new", "orders_old"],
)
def keys_only_new(spark, sf_dir):
    return keys.keys_only_new(fx.orders_new(spark, sf_dir), fx.orders_old(spark, sf_dir), KEY)


@query(
    """SELECT mo, count(*) AS copies FROM orders_old_empty o
       WHERE NOT EXISTS (SELECT 1 FROM orders_new n WHERE o.mo = n.mo) GROUP BY mo""",
    ["orders_new", "orders_old_empty"],
)
def keys_only_old(spark, sf_dir):
    return keys.keys_only_old(fx.orders_new(spark, sf_dir), fx.orders_old_empty(spark, sf_dir), KEY)


@query(
    """SELECT (SELECT count(*) FROM t) AS new_rows,
              (SELECT count(*) FROM orders_old) AS old_rows,
              (SELECT count(*) FROM orders_text WHERE mo IS NULL) AS new_null_keys,
              (SELECT count(*) FROM orders_old WHERE mo IS NULL) AS old_null_keys,
              (SELECT count(*) FROM orders_text
               WHERE mo IS NOT NULL AND TRY_CAST(mo AS BIGINT) IS NULL) AS new_bad_keys,
              CAST(0 AS BIGINT) AS old_bad_keys,
              (SELECT count(DISTINCT k) FROM t WHERE k IN (SELECT mo FROM orders_old)) AS matched_keys,
              (SELECT count(DISTINCT k) FROM t
               WHERE k NOT IN (SELECT mo FROM orders_old)) AS only_new_keys,
              (SELECT count(DISTINCT mo) FROM orders_old
               WHERE mo NOT IN (SELECT k FROM t WHERE k IS NOT NULL)) AS only_old_keys""".replace(
        "FROM t", "FROM (SELECT TRY_CAST(mo AS BIGINT) AS k FROM orders_text)"
    ),
    ["orders_text", "orders_old"],
)
def side_counts(spark, sf_dir):
    return keys.side_counts(fx.orders_text(spark, sf_dir), fx.orders_old(spark, sf_dir), KEY)


@query(
    """SELECT mo, n.n_new, o.n_old
       FROM (SELECT mo, count(*) AS n_old FROM orders_old_dup GROUP BY mo HAVING count(*) > 1) o
       JOIN (SELECT mo, count(*) AS n_new FROM orders_new GROUP BY mo) n USING (mo)""",
    ["orders_new", "orders_old_dup"],
)
def duplicate_keys(spark, sf_dir):
    return keys.duplicate_keys(fx.orders_new(spark, sf_dir), fx.orders_old_dup(spark, sf_dir), KEY)


# Comparison.


@query(
    "SELECT mo, i1, i2, i3, i4 FROM orders_new WHERE mo IN (SELECT 3 * l_partkey FROM lineitem)",
    ["orders_new"],
)
def listed_orders(spark, sf_dir):
    """Restriction to a list that counts as too long to be sent whole."""
    listed = fx.table(spark, sf_dir, "lineitem").select((3 * F.col("l_partkey")).cast("bigint").alias("mo"))
    return restrict_to_listed(fx.orders_new(spark, sf_dir), listed, KEY, sent_keys=10)


@query(
    f"SELECT mo, {', '.join(f'x_{k}, y_{k}' for k in KPIS)} FROM pairs_orders_old_dup",
    ["pairs_orders_old_dup"],
)
def matched_rows(spark, sf_dir):
    return compare.matched_rows(
        fx.orders_new(spark, sf_dir), fx.orders_old_dup(spark, sf_dir), KEY, KPIS
    )


@query(
    "SELECT sd, st, mo, x1 AS x_i1, y1 AS y_i1, x3 AS x_i3, y3 AS y_i3 FROM group_pairs "
    "WHERE (sd, st, mo) IN (SELECT (sd, st, mo) FROM group_entities)",
    ["group_pairs", "group_entities"],
)
def entity_restricted(spark, sf_dir):
    groups = task_plans.task_groups(fx.event_tasks(spark, sf_dir))
    listed = written(task_plans.listed_entities(groups))
    # Cut before they are matched, so that only listed entities are shuffled.
    sides = [
        keys.restrict_entities(side(spark, sf_dir), listed, EVENT_KEY)
        for side in (fx.events_new, fx.events_old)
    ]
    matched = compare.matched_rows(*sides, EVENT_KEY, ["i1", "i3"])
    return matched.drop("motype", "period")


_MISMATCHES = " UNION ALL ".join(
    f"""SELECT mo, '{k}' AS kpi, x_{k} AS x, y_{k} AS y, x_{k} - y_{k} AS diff
        FROM pairs_orders_old WHERE NOT abs(x_{k} - y_{k}) <= 0.01"""
    for k in KPIS
)


@query(_MISMATCHES, ["pairs_orders_old"])
def field_mismatch(spark, sf_dir):
    return compare.field_mismatches(
        fx.orders_new(spark, sf_dir), fx.orders_old(spark, sf_dir), KEY, KPIS
    )


@query(_MISMATCHES, ["pairs_orders_old"])
def field_mismatch_long(spark, sf_dir):
    sides = fx.orders_new(spark, sf_dir), fx.orders_old(spark, sf_dir)
    return compare.compare_long_of(*sides, KEY, KPIS, only_bad=True).drop("is_bad", "is_failed")


@query(_MISMATCHES, ["pairs_orders_old"])
def field_mismatch_melted(spark, sf_dir):
    """The same for copies that come in long form."""
    new = compare.melt(fx.orders_new(spark, sf_dir), KEY, KPIS)
    old = compare.melt(fx.orders_old(spark, sf_dir), KEY, KPIS)
    return compare.compare_long(new, old, KEY).where("is_bad").drop("is_bad", "is_failed")


def _detail_sql(old: str, condition: str) -> str:
    bad = ", ".join(f"CASE WHEN {condition.format(k=k)} THEN '{k}' END" for k in KPIS)
    return f"""
        SELECT mo, '[' || fields || ']' AS fields
        FROM (SELECT mo, concat_ws(', ', {bad}) AS fields FROM pairs_{old}) WHERE fields <> ''"""


_BAD = "x_{k} IS NOT NULL AND y_{k} IS NOT NULL AND NOT abs(x_{k} - y_{k}) <= 0.01"


def _reported(spark: SparkSession, sf_dir: str, old: Callable, always: bool) -> DataFrame:
    cmp = compare.compare_wide(fx.orders_new(spark, sf_dir), old(spark, sf_dir), KEY, KPIS)
    return report_details(cmp, [], len(KPIS), always=always)


@query(_detail_sql("orders_old_fail", _BAD), ["pairs_orders_old_fail"])
def mismatch_detail(spark, sf_dir):
    return _reported(spark, sf_dir, fx.orders_old_fail, always=False)


@query(_detail_sql("orders_old", _BAD), ["pairs_orders_old"])
def mismatch_detail_all(spark, sf_dir):
    return _reported(spark, sf_dir, fx.orders_old, always=True)


def _by_kpi_sql(condition: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{k}' AS kpi, count(*) FILTER ({condition.format(k=k)}) AS n
            FROM pairs_orders_old"""
        for k in KPIS
    )


@query(_by_kpi_sql(_BAD), ["pairs_orders_old"])
def errors_by_kpi(spark, sf_dir):
    return compare.errors_by_kpi(
        fx.orders_new(spark, sf_dir), fx.orders_old(spark, sf_dir), KEY, KPIS
    )


@query(_by_kpi_sql("x_{k} IS NULL OR y_{k} IS NULL"), ["pairs_orders_old"])
def null_pairs(spark, sf_dir):
    return compare.null_pairs(
        fx.orders_new(spark, sf_dir), fx.orders_old(spark, sf_dir), KEY, KPIS
    )


_ROW_DIFF = "SELECT mo, i1, i2, i3, i4 FROM orders_new EXCEPT SELECT mo, i1, i2, i3, i4 FROM orders_old"


@query(_ROW_DIFF, ["orders_new", "orders_old"])
def exact_row_diff(spark, sf_dir):
    return compare.exact_row_diff(fx.orders_new(spark, sf_dir), fx.orders_old(spark, sf_dir))


@query(_ROW_DIFF, ["orders_new", "orders_old"])
def exact_row_diff_digest(spark, sf_dir):
    """The same by digests, as for wide tables."""
    return digest_row_diff(fx.orders_new(spark, sf_dir), fx.orders_old(spark, sf_dir))


@query(_detail_sql("orders_old", "x_{k} IS DISTINCT FROM y_{k}"), ["pairs_orders_old"])
def exact_field_diff(spark, sf_dir):
    return compare.exact_field_diff(
        fx.orders_new(spark, sf_dir), fx.orders_old(spark, sf_dir), KEY, KPIS
    )


# Tasks.


@query(
    """SELECT DISTINCT p_brand AS motype, 'h' AS period, CAST(20190926 AS INTEGER) AS start_day,
              CAST(0 AS INTEGER) AS start_time, CAST(20190926 AS INTEGER) AS sheet_day_1,
              CAST(20190926 AS INTEGER) AS sheet_day_2, CAST(20190926 AS INTEGER) AS sheet_day_3
       FROM part"""
)
def generate_tasks(spark, sf_dir):
    brands = fx.table(spark, sf_dir, "part").select(F.col("p_brand").alias("motype")).distinct()
    return task_plans.generate_tasks(brands)


@query(
    """SELECT motype, 'h' AS period, start_day, start_time,
              start_day AS sheet_day_1, start_day AS sheet_day_2, start_day AS sheet_day_3
       FROM (SELECT motype, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS start_day,
                    CAST(unnest(generate_series(0, 23)) AS INTEGER) AS start_time
             FROM (SELECT 'm' || CAST(user_id % 7 AS VARCHAR) AS motype,
                          unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS d
                   FROM events GROUP BY 1))"""
)
def generate_tasks_range(spark, sf_dir):
    model = F.concat(F.lit("m"), F.col("user_id") % 7).alias("motype")
    span = (F.to_date(F.min("ts")).alias("first"), F.to_date(F.max("ts")).alias("last"))
    models = fx.table(spark, sf_dir, "events").groupBy(model).agg(*span)
    times = F.sequence(F.lit(0), F.lit(23))
    return task_plans.generate_tasks_range(models, F.col("first"), F.col("last"), times)


def _file(df: DataFrame) -> str:
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid4().hex}"
    df.write.json(path)
    return path


@query(
    """SELECT task_id, motype, period, start_day, start_time, indicators, moentities FROM event_tasks
       WHERE task_id % 3 <> 0""",
    ["event_tasks"],
)
def task_source(spark, sf_dir):
    """Tasks read from files, without those that the ledger knows."""
    tasks = read_tasks(spark, _file(fx.event_tasks(spark, sf_dir)), "json")
    begun = tasks.where("task_id % 3 = 0")
    return pending_tasks(tasks, task_plans.running_rows(begun.unionAll(begun)))


@query("SELECT DISTINCT CAST(p_brand AS VARCHAR) AS motype FROM part")
def model_source(spark, sf_dir):
    brands = fx.table(spark, sf_dir, "part").select(F.col("p_brand").alias("motype")).distinct()
    return read_models(spark, _file(brands), "json")


@query("SELECT * FROM event_groups", ["event_groups"])
def task_groups(spark, sf_dir):
    return task_plans.task_groups(fx.event_tasks(spark, sf_dir))


@query(
    """SELECT motype, lower(period) AS period, start_day AS sd, start_time AS st,
              CAST(0 AS BIGINT) AS chunk,
              string_agg(CAST(task_id AS VARCHAR), ',' ORDER BY task_id) AS task_ids
       FROM event_tasks GROUP BY ALL""",
    ["event_tasks"],
)
def group_task_ids(spark, sf_dir):
    ids = task_plans.group_task_ids(fx.event_tasks(spark, sf_dir))
    return ids.withColumn("task_ids", F.array_join("task_ids", ","))


@query(
    """SELECT motype, lower(period) AS period, start_day AS sd, start_time AS st,
              row_number() OVER (PARTITION BY motype, lower(period), start_day, start_time
                                 ORDER BY task_id) - 1 AS chunk,
              CAST(task_id AS VARCHAR) AS task_ids
       FROM event_tasks""",
    ["event_tasks"],
)
def group_task_ids_chunks(spark, sf_dir):
    """Lists of one id, so that slices with several tasks have several lists."""
    ids = task_plans.group_task_ids(fx.event_tasks(spark, sf_dir), size=1)
    return ids.withColumn("task_ids", F.array_join("task_ids", ","))


@query(
    """SELECT sd, st, count(*) AS n, sum(i1) AS i1, sum(i2) AS i2, max(i3) AS i3 FROM events_new GROUP BY sd, st""",
    ["events_new"],
)
def named_tables(spark, sf_dir):
    """A table found by the name of its model, and read under a name of its own in SQL."""
    fx.events_new(spark, sf_dir).createOrReplaceTempView("t_events_h")
    kpis = table_kpis(spark, "events", "H")
    view = named_view(kpi_table(spark, "events", "H").select("sd", "st", *kpis), "events")
    return spark.sql(f"SELECT sd, st, count(*) AS n, sum(i1) AS i1, sum(i2) AS i2, max(i3) AS i3 FROM {view} GROUP BY sd, st")


def _batch(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, Batch]:
    tasks = fx.event_tasks(spark, sf_dir)
    new, old = fx.events_new(spark, sf_dir), fx.events_old(spark, sf_dir)
    return tasks, reconcile_batch(tasks, new, old, fx.EVENT_KPIS, **options)


_RESULT = "motype, period, sd, st, matched, all_n, right_n, error_n, null_n, rate"


@query(f"SELECT {_RESULT}, CAST(status AS INTEGER) AS status FROM group_results", ["group_results"])
def batch_reconcile(spark, sf_dir):
    return _batch(spark, sf_dir)[1].results.drop(*KEY_COUNTS)


@query(f"SELECT {_RESULT}, CAST(status AS INTEGER) AS status FROM group_results", ["group_results"])
def batch_fingerprint(spark, sf_dir):
    return _batch(spark, sf_dir, fingerprints=True)[1].results.drop(*KEY_COUNTS)


@query(
    """SELECT g.sd, g.st, count(*) FILTER (n.mo IS NOT NULL AND o.mo IS NOT NULL) AS matched,
              count(*) FILTER (n.mo IS NOT NULL AND o.mo IS NULL) AS only_new,
              count(*) FILTER (n.mo IS NULL AND o.mo IS NOT NULL) AS only_old
       FROM (SELECT DISTINCT sd, st FROM event_groups) g
       LEFT JOIN (SELECT sd, st, mo FROM events_new UNION SELECT sd, st, mo FROM events_old) k
         ON k.sd = g.sd AND k.st = g.st
       LEFT JOIN events_new n ON n.sd = k.sd AND n.st = k.st AND n.mo = k.mo
       LEFT JOIN events_old o ON o.sd = k.sd AND o.st = k.st AND o.mo = k.mo
       GROUP BY ALL""",
    ["event_groups", "events_new", "events_old"],
)
def batch_keys(spark, sf_dir):
    """Matched and one-sided keys of each slice, tasks without lists of entities."""
    tasks = fx.event_tasks(spark, sf_dir).withColumn("moentities", F.lit(None).cast("string"))
    new, old = fx.events_new(spark, sf_dir), fx.events_old(spark, sf_dir)
    results = reconcile_batch(tasks, new, old, fx.EVENT_KPIS).results
    return results.select("sd", "st", "matched", "only_new", "only_old")


@query(
    """SELECT motype, sd, st, CASE WHEN NOT broken THEN CAST(all_n AS BIGINT) END AS all_n,
              CASE WHEN NOT broken THEN CAST(error_n AS BIGINT) END AS error_n,
              CAST(CASE WHEN broken THEN 2 WHEN CAST(all_n - error_n AS DOUBLE) / all_n > 0.99 THEN 1
                        ELSE -1 END AS INTEGER) AS status
       FROM (SELECT 'orders' AS motype, sd, st, 2 * count(*) FILTER (mo % 10 <> 0) AS all_n,
                    count(*) FILTER (mo % 10 <> 0 AND mo % 100 = 7 AND r1 IS NOT NULL) AS error_n,
                    st = 0 OR count(*) FILTER (mo % 10 <> 0) = 0 AS broken
             FROM export_rows GROUP BY sd, st
             UNION ALL
             SELECT 'events', sd, st, 3 * count(*), count(*) FILTER (st = 7 AND i3 IS NOT NULL), false
             FROM events_new GROUP BY sd, st)""",
    ["export_rows", "events_new"],
)
def batch_models(spark, sf_dir):
    """Two models with different KPIs; the old copies have their names in upper case, and
    the old orders lack a KPI that the tasks on one slot check."""
    tasks, new, old = fx.two_models(spark, sf_dir)
    catalog, old_catalog = catalog_of(new), catalog_of(old)
    facts = [facts_of(spark, side, catalog) for side in (new, old)]
    results = reconcile_batch(tasks, *facts, value_columns(catalog), catalog, old_catalog).results
    judged = F.col("status") != 2
    counts = [F.when(judged, F.col(c)).alias(c) for c in ("all_n", "error_n")]
    return results.select("motype", "sd", "st", *counts, "status")


@query(
    """SELECT m.motype, sd, st, CAST(CASE
              WHEN m.motype IN ('nokey', 'textday') OR m.motype = 'datekpi' AND st <> 0
                OR m.motype = 'nankey' AND count(*) FILTER (mo % 500 = 0) > 0 THEN 2
              ELSE 1 END AS INTEGER) AS status
       FROM export_rows, (SELECT unnest(['nokey', 'datekpi', 'textday', 'nankey']) AS motype) m
       GROUP BY m.motype, sd, st
       UNION ALL
       SELECT DISTINCT 'sound', sd, st, CAST(1 AS INTEGER) FROM events_new""",
    ["export_rows", "events_new"],
)
def batch_faulty_tables(spark, sf_dir):
    """A table without keys, a KPI that is a date, unreadable days and keys that are NaN,
    beside a sound model."""
    tasks, new, old = fx.faulty_models(spark, sf_dir)
    batch, _ = reconcile_tables(tasks, inspect(new, "new"), inspect(old, "old"))
    return batch.results.select("motype", "sd", "st", "status")


@query(
    """SELECT 'nokey' AS motype, 'new' AS side, 'mo' AS place, 'no column' AS reason, CAST(NULL AS BIGINT) AS n
       UNION ALL SELECT 'datekpi', 'old', 'i1', 'kpi without numbers', NULL
       UNION ALL SELECT 'textday', 'old', 'sd, st', 'no slot', count(*) FROM export_rows WHERE mo % 101 = 0""",
    ["export_rows"],
)
def table_faults(spark, sf_dir):
    _, new, old = fx.faulty_models(spark, sf_dir)
    return fault_rows(spark, [inspect(new, "new"), inspect(old, "old")]).drop("period")


@query(
    """SELECT g.sd, g.st, coalesce(matched, 0) AS matched,
              CAST(CASE WHEN coalesce(matched, 0) = 0 OR junk > 0 OR dup > 0 THEN 2
                        WHEN CAST(3 * matched - error_n AS DOUBLE) / (3 * matched) > 0.99 THEN 1
                        ELSE -1 END AS INTEGER) AS status
       FROM (SELECT DISTINCT sd, st FROM event_groups) g
       LEFT JOIN (SELECT sd, st, count(*) FILTER (NOT (st = 6 AND mo % 4 = 0)) AS matched,
                         count(*) FILTER (st = 5 AND mo % 3 = 0) AS junk,
                         count(*) FILTER (st = 6 AND mo % 4 = 0) AS dup,
                         count(*) FILTER (st = 7 AND i3 IS NOT NULL) AS error_n
                  FROM events_new WHERE NOT (sd = 20240105 AND st = 3) GROUP BY sd, st) s
         ON s.sd = g.sd AND s.st = g.st""",
    ["event_groups", "events_new"],
)
def batch_broken(spark, sf_dir):
    """An old copy as text, with values that are no numbers and keys that are there twice."""
    tasks = fx.event_tasks(spark, sf_dir).withColumns(
        {c: F.lit(None).cast("string") for c in ("indicators", "moentities")}
    )
    old = fx.events_old(spark, sf_dir)
    junk = F.when((F.col("st") == 5) & (F.col("mo") % 3 == 0), "n/a").otherwise(F.col("i1").cast("string"))
    old = old.unionByName(old.where("st = 6 AND mo % 4 = 0")).withColumn("i1", junk)
    results = reconcile_batch(tasks, fx.events_new(spark, sf_dir), old, fx.EVENT_KPIS).results
    return results.select("sd", "st", "matched", "status")


def _batch_detail_sql(condition: str) -> str:
    return f"""
        SELECT motype, period, sd, st, mo, '[' || string_agg(label, ', ' ORDER BY no) || ']' AS fields
        FROM group_fields JOIN group_results r USING (motype, period, sd, st)
        WHERE {condition} AND NOT abs(x - y) <= 0.01 GROUP BY ALL"""


@query(_batch_detail_sql("r.status = -1"), ["group_fields", "group_results"])
def batch_details(spark, sf_dir):
    return _batch(spark, sf_dir)[1].details


@query(_batch_detail_sql("r.status <> 2"), ["group_fields", "group_results"])
def batch_details_all(spark, sf_dir):
    return _batch(spark, sf_dir, always=True)[1].details


@query(_batch_detail_sql("r.status <> 2"), ["group_fields", "group_results"])
def batch_details_passing(spark, sf_dir):
    """At this threshold every slice that can be judged passes; all details are of such."""
    return _batch(spark, sf_dir, threshold=0.5, always=True)[1].details


_TASK_RESULTS = f"""
    SELECT t.task_id, CAST(r.status AS INTEGER) AS status,
           CASE WHEN r.status <> 2 THEN all_n END AS all_n,
           CASE WHEN r.status <> 2 THEN right_n END AS right_n,
           CASE WHEN r.status <> 2 THEN error_n END AS error_n,
           CASE WHEN r.status <> 2 THEN CAST({STAMP_LONG} AS BIGINT) END AS finish_time
    FROM event_tasks t JOIN group_results r
      ON t.motype = r.motype AND lower(t.period) = r.period
     AND t.start_day = r.sd AND t.start_time = r.st"""

_OUTCOMES = f"""
    SELECT task_id, CAST(1 AS INTEGER) AS seq, status, all_n, right_n, error_n,
           CAST({STAMP_LONG} AS BIGINT) AS stamp FROM ({_TASK_RESULTS})"""

_LEDGER = f"""
    SELECT task_id, CAST(0 AS INTEGER) AS seq, CAST(3 AS INTEGER) AS status,
           CAST(NULL AS BIGINT) AS all_n, CAST(NULL AS BIGINT) AS right_n,
           CAST(NULL AS BIGINT) AS error_n, CAST({STAMP_LONG} AS BIGINT) AS stamp
    FROM event_tasks UNION ALL {_OUTCOMES}"""


def _at():
    return F.lit(STAMP).cast("timestamp")


@query(_TASK_RESULTS, ["event_tasks", "group_results"])
def task_results(spark, sf_dir):
    tasks, batch = _batch(spark, sf_dir)
    return task_plans.result_rows(batch.results, tasks, _at())


@query(_LEDGER, ["event_tasks", "group_results"])
def task_ledger(spark, sf_dir):
    tasks, batch = _batch(spark, sf_dir)
    outcome = task_plans.outcome_rows(batch.results, tasks, _at())
    return task_plans.running_rows(tasks, _at()).unionAll(outcome)


# The run was begun again, for every third slot, and has no outcome yet.
_REPEATED = "start_time % 3 = 0"


@query(
    f"""SELECT task_id, seq, status, all_n, right_n, error_n, stamp FROM ({_OUTCOMES})
        WHERE task_id NOT IN (SELECT task_id FROM event_tasks WHERE {_REPEATED})
        UNION ALL
        SELECT task_id, CAST(0 AS INTEGER), CAST(3 AS INTEGER), NULL, NULL, NULL, CAST({STAMP_LONG + 1} AS BIGINT)
        FROM event_tasks WHERE {_REPEATED}""",
    ["event_tasks", "group_results"],
)
def task_latest_status(spark, sf_dir):
    tasks, batch = _batch(spark, sf_dir)
    outcome = task_plans.outcome_rows(batch.results, tasks, _at())
    first = task_plans.running_rows(tasks, _at()).unionAll(outcome)
    later = _at() + F.expr("interval 1 second")
    second = task_plans.running_rows(tasks.where(_REPEATED), later)
    numbered = [df.withColumns({"run": F.lit("r"), "attempt": F.lit(n)}) for n, df in ((1, first), (2, second))]
    return task_plans.latest_status(numbered[0].unionAll(numbered[1])).drop("run", "attempt")


# Key/value metadata.


@query(
    "SELECT field AS motype, value AS model_name FROM hashes WHERE key = 'ALLMODELMAPPING'", ["hashes"]
)
def kv_mapping(spark, sf_dir):
    return lookup.model_names(fx.hashes(spark, sf_dir))


@query("SELECT field, value FROM hashes WHERE key = 'ALLMODELMAPPING'", ["hashes"])
def keyed_hash(spark, sf_dir):
    """One hash of many, written as keyed rows in order and read by its key."""
    keyed.register(spark)
    path = f"{ensure_checkpoint_dir(spark)}/{uuid4().hex}"
    fx.hashes(spark, sf_dir).orderBy("key").write.format("keyed").mode("append").save(path)
    found = spark.read.format("keyed").option("key", lookup.MODEL_NAMES).load(path)
    return lookup.hash_entries(found, lookup.MODEL_NAMES)


@query(
    """SELECT m.motype, h.value AS model_name FROM models m
       LEFT JOIN hashes h ON h.key = 'ALLMODELMAPPING' AND h.field = m.motype""",
    ["models", "hashes"],
)
def kv_mapping_join(spark, sf_dir):
    return lookup.with_model_name(fx.models(spark, sf_dir), fx.hashes(spark, sf_dir))


@query(
    """SELECT motype, mo, field, value
       FROM (SELECT motype, key, mo FROM (
                 SELECT i.motype, h.key, h.value AS mo, row_number() OVER (
                            PARTITION BY i.motype, h.value ORDER BY i.n DESC, i.no DESC) AS back
                 FROM (SELECT motype, n, unnest(ids) AS id, generate_subscripts(ids, 1) AS no
                       FROM (SELECT motype, n, string_split(ids, ',') AS ids FROM lists)) i
                 JOIN hashes s ON s.key = 'MOTYPE:MOTYPEID:SEQUENCE' AND s.field = i.motype
                 JOIN hashes h ON h.key = 'OBJ:' || s.value || ':' || i.id AND h.field = 'MO'
                 WHERE lower(h.value) <> 'null')
             WHERE back = 1)
       JOIN hashes USING (key)""",
    ["lists", "hashes"],
)
def kv_entities(spark, sf_dir):
    return lookup.model_objects(
        fx.models(spark, sf_dir), fx.hashes(spark, sf_dir), fx.texts(spark, sf_dir)
    )


@query(
    """SELECT m.motype, CAST(c.no - 1 AS INTEGER) AS pos, c.column_name FROM models m
       LEFT JOIN (SELECT key, unnest(parts) AS column_name, generate_subscripts(parts, 1) AS no
                  FROM (SELECT key, string_split(regexp_replace(value, ',+$', ''), ',') AS parts
                        FROM texts)) c ON c.key = 'MOTYPE:CONFIG:' || m.motype""",
    ["models", "texts"],
)
def kv_meta_columns(spark, sf_dir):
    return lookup.model_columns(fx.models(spark, sf_dir), fx.texts(spark, sf_dir))


@query(
    """SELECT field AS indicator_id, 'I' || value AS column_name FROM hashes
       WHERE key = 'ALLINDICATORID2SEQ:CONF'""",
    ["hashes"],
)
def kv_indicator_columns(spark, sf_dir):
    return lookup.indicator_columns(fx.hashes(spark, sf_dir))


_ID_LIST = ", ".join(f"'{i}'" for i in members.LOGICAL_MODEL_IDS)


@query(f"SELECT * FROM part_models WHERE motype IN ({_ID_LIST})", ["part_models"])
def set_member(spark, sf_dir):
    return members.set_members(fx.part_models(spark, sf_dir))


@query(
    f"SELECT * FROM part_models WHERE motype IS NULL OR motype NOT IN ({_ID_LIST})", ["part_models"]
)
def set_nonmember(spark, sf_dir):
    return members.set_nonmembers(fx.part_models(spark, sf_dir))


# Export and batches.

_HEADING = packed.heading(fx.EXPORT_COLUMNS)


@query(
    f"""SELECT DISTINCT motype, period, sd, st, CAST(0 AS INTEGER) AS line_no, '{_HEADING}' AS line
        FROM export_rows
        UNION ALL
        SELECT motype, period, sd, st, CAST(1 AS INTEGER), line FROM export_lines""",
    ["export_rows", "export_lines"],
)
def packed_lines(spark, sf_dir):
    return packed.packed_lines(fx.export_rows(spark, sf_dir), fx.EXPORT_COLUMNS).drop("_order")


@query(
    f"""SELECT motype, period, sd, st, part,
               '{_HEADING}' || chr(13) || chr(10)
               || string_agg(line || chr(13) || chr(10), '' ORDER BY mo, line) AS text
        FROM (SELECT *, (row_number() OVER (
                  PARTITION BY motype, period, sd, st ORDER BY mo, line) - 1) // 50 AS part
              FROM export_lines)
        GROUP BY ALL""",
    ["export_lines"],
)
def packed_blob(spark, sf_dir):
    return packed.packed_blobs(fx.export_rows(spark, sf_dir), fx.EXPORT_COLUMNS, size=50)


@query(
    """SELECT motype, period, sd, st, (pos - 1) // 50 AS part, CAST((pos - 1) % 50 + 1 AS INTEGER) AS line_no, line
       FROM (SELECT *, row_number() OVER (PARTITION BY motype, period, sd, st ORDER BY mo, line) AS pos
             FROM export_lines)""",
    ["export_lines"],
)
def packed_roundtrip(spark, sf_dir):
    """Packed texts written as keyed rows, read back and taken apart."""
    path = f"{ensure_checkpoint_dir(spark)}/{uuid4().hex}"
    save_blobs(packed.packed_blobs(fx.export_rows(spark, sf_dir), fx.EXPORT_COLUMNS, size=50), path)
    return read_blob_lines(spark, path)


def _batch_sql(view: str, by: str, size: int) -> str:
    return f"""
        SELECT {by}, mo, (row_number() OVER (PARTITION BY {by} ORDER BY mo DESC) - 1) // {size} AS batch
        FROM {view}"""


@query(_batch_sql("events_new", "motype, period, sd, st", 4), ["events_new"])
def key_batches(spark, sf_dir):
    return batches.key_batches(fx.events_new(spark, sf_dir), SLICE, size=4)


@query(
    _batch_sql(
        "(SELECT l_linestatus, l_orderkey AS mo FROM lineitem GROUP BY ALL)",
        "l_linestatus",
        IDS_PER_CHUNK,
    )
)
def list_chunks(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    ids = lines.select("l_linestatus", F.col("l_orderkey").alias("mo"))
    return batches.key_batches(ids, ["l_linestatus"], size=IDS_PER_CHUNK)


# Functions that share a name with the operator they show.
for _name in [name for name in QUERIES if name.endswith("_query")]:
    QUERIES[_name.removesuffix("_query")] = QUERIES.pop(_name)
    SQL[_name.removesuffix("_query")] = SQL.pop(_name)
