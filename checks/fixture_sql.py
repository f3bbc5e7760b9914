"""The fixtures of ``checks/fixtures.py`` in SQL, as common table expressions."""

from __future__ import annotations

from slicecheck.functions.models import LOGICAL_MODEL_IDS

_IDS = ", ".join(f"'{i}'" for i in LOGICAL_MODEL_IDS)
_N_IDS = len(LOGICAL_MODEL_IDS)


def _orders_old(shift_every: int) -> str:
    return f"""
        SELECT mo,
               CASE WHEN mo % {shift_every} = 0 OR mo % 97 = 0 THEN i1 + CAST(1.0 AS DOUBLE)
                    WHEN mo % 89 = 0 THEN i1 + CAST(0.005 AS DOUBLE) ELSE i1 END AS i1,
               CASE WHEN mo % 83 <> 0 THEN i2 END AS i2,
               CASE WHEN mo % 101 = 0 THEN i3 * CAST(1.1 AS DOUBLE) ELSE i3 END AS i3,
               i4
        FROM orders_new WHERE mo % 50 <> 0"""


def _pairs(old: str) -> str:
    """Rows found once on each side."""
    return f"""
        SELECT n.mo, n.i1 AS x_i1, n.i2 AS x_i2, n.i3 AS x_i3, n.i4 AS x_i4,
               o.i1 AS y_i1, o.i2 AS y_i2, o.i3 AS y_i3, o.i4 AS y_i4
        FROM orders_new n JOIN {old} o ON n.mo = o.mo
        WHERE n.mo NOT IN (SELECT mo FROM {old} GROUP BY mo HAVING count(*) > 1)"""


# name -> (views it reads, SQL)
VIEWS: dict[str, tuple[list[str], str]] = {
    "orders_new": (
        [],
        """
        SELECT o.o_orderkey AS mo, o.o_totalprice AS i1, l.i2, l.i3, l.i4
        FROM orders o JOIN (
            SELECT l_orderkey, sum(l_quantity) AS i2, max(l_extendedprice) AS i3,
                   CAST(count(*) AS DOUBLE) AS i4
            FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey""",
    ),
    "orders_old": (["orders_new"], _orders_old(97)),
    "orders_old_fail": (["orders_new"], _orders_old(10)),
    "orders_old_empty": (["orders_old"], "SELECT -1 - mo AS mo, i1, i2, i3, i4 FROM orders_old"),
    "orders_old_dup": (
        ["orders_old"],
        """SELECT * FROM orders_old
        UNION ALL SELECT * FROM orders_old WHERE mo % 1000 = 1""",
    ),
    **{
        f"pairs_{old}": (["orders_new", old], _pairs(old))
        for old in ("orders_old", "orders_old_fail", "orders_old_empty", "orders_old_dup")
    },
    "orders_text": (
        [],
        """
        SELECT CASE WHEN o_orderkey % 211 = 0 THEN 'null'
                    ELSE CAST(o_orderkey AS VARCHAR) END AS mo,
               CAST(o_custkey AS VARCHAR) AS i1,
               CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
                    WHEN o_orderkey % 89 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS i2,
               CASE WHEN o_orderkey % 83 = 0 THEN o_orderpriority
                    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS i3,
               CAST(length(o_orderpriority) AS INTEGER) AS i4,
               o_orderstatus AS name
        FROM orders""",
    ),
    "events_new": (
        [],
        """
        SELECT 'events' AS motype, 'h' AS period,
               CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS sd, CAST(hour(ts) AS INTEGER) AS st,
               user_id AS mo,
               CAST(count(*) FILTER (event_type = 'click') AS DOUBLE) AS i1,
               CAST(count(*) FILTER (event_type = 'view') AS DOUBLE) AS i2,
               max(value) AS i3
        FROM events GROUP BY ALL""",
    ),
    "events_old": (
        ["events_new"],
        """
        SELECT motype, period, sd, st, mo, i1, i2,
               CASE WHEN st = 7 THEN i3 + 1 ELSE i3 END AS i3
        FROM events_new WHERE NOT (sd = 20240105 AND st = 3)""",
    ),
    "event_tasks": (
        [],
        """
        SELECT * FROM (
            WITH hours AS (
                SELECT DISTINCT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS start_day,
                       CAST(hour(ts) AS INTEGER) AS start_time FROM events),
            first AS (
                SELECT CAST(start_day AS BIGINT) * 100 + start_time AS task_id,
                       'events' AS motype, 'H' AS period, start_day, start_time,
                       CASE WHEN start_time = 11 THEN 'i1,i9'
                            WHEN start_time = 13 THEN 'i2,,'
                            WHEN start_time = 14 THEN ','
                            WHEN start_time = 15 THEN 'mo, I3'
                            WHEN start_time % 4 = 1 THEN 'i1,i3'
                            WHEN start_time % 4 = 3 THEN 'i3,i2,i1' END AS indicators,
                       CASE WHEN start_time % 8 = 7 AND start_day % 2 = 0 THEN
                            start_time || ',' || (start_time + 24) || ',' || (start_time + 48)
                            || ',' || (start_day % 100) || ',x' END AS moentities
                FROM hours)
            SELECT * FROM first
            UNION ALL
            SELECT task_id + 10000000000, motype, period, start_day, start_time, 'i2', NULL
            FROM first WHERE start_time % 6 = 0
            UNION ALL
            SELECT DISTINCT CAST(start_day AS BIGINT) * 100 + 24, 'events', 'h', start_day, 24,
                   NULL, NULL FROM hours)""",
    ),
    "event_groups": (
        ["event_tasks"],
        """
        SELECT motype, lower(period) AS period, start_day AS sd, start_time AS st,
               count(*) AS n_tasks, min(task_id) AS first_task_id,
               max(indicators) FILTER (rank = 1) AS indicators,
               max(moentities) FILTER (rank = 1) AS moentities
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY motype, lower(period), start_day, start_time
                  ORDER BY task_id) AS rank FROM event_tasks)
        GROUP BY ALL""",
    ),
    # Labels are listed per group; a label with a number is a column of the events.
    "group_kpis": (
        ["event_groups"],
        """
        SELECT motype, period, sd, st, no, label, lower(trim(label)) AS kpi FROM (
            SELECT motype, period, sd, st,
                   unnest(labels) AS label, generate_subscripts(labels, 1) AS no
            FROM (SELECT *, CASE WHEN indicators IS NULL THEN ['i1', 'i2', 'i3']
                                 WHEN regexp_matches(indicators, '^,+$') THEN []
                                 ELSE string_split(regexp_replace(indicators, ',+$', ''), ',')
                            END AS labels FROM event_groups))
        WHERE lower(trim(label)) <> 'mo'""",
    ),
    "group_entities": (
        ["event_groups"],
        """
        SELECT DISTINCT motype, period, sd, st, TRY_CAST(trim(item) AS BIGINT) AS mo
        FROM (SELECT *, unnest(string_split(moentities, ',')) AS item FROM event_groups
              WHERE moentities IS NOT NULL)
        WHERE TRY_CAST(trim(item) AS BIGINT) IS NOT NULL""",
    ),
    "group_pairs": (
        ["event_groups", "group_entities", "events_new", "events_old"],
        """
        SELECT motype, period, sd, st, mo, n.i1 AS x1, o.i1 AS y1, n.i2 AS x2, o.i2 AS y2,
               n.i3 AS x3, o.i3 AS y3
        FROM events_new n JOIN events_old o USING (motype, period, sd, st, mo)
        JOIN event_groups g USING (motype, period, sd, st)
        WHERE g.moentities IS NULL
           OR (sd, st, mo) IN (SELECT (sd, st, mo) FROM group_entities)""",
    ),
    "group_fields": (
        ["group_pairs", "group_kpis"],
        """
        SELECT motype, period, sd, st, mo, k.no, k.label, k.kpi,
               CASE k.kpi WHEN 'i1' THEN x1 WHEN 'i2' THEN x2 WHEN 'i3' THEN x3 END AS x,
               CASE k.kpi WHEN 'i1' THEN y1 WHEN 'i2' THEN y2 WHEN 'i3' THEN y3 END AS y
        FROM group_pairs JOIN group_kpis k USING (motype, period, sd, st)""",
    ),
    "group_results": (
        ["event_groups", "group_kpis", "group_pairs", "group_fields"],
        """
        SELECT *, CASE WHEN NOT known OR matched = 0 THEN 2
                       WHEN rate > 0.99 THEN 1 ELSE -1 END AS status
        FROM (SELECT *, all_n - error_n AS right_n,
                     CASE WHEN all_n > 0 THEN
                          CAST(all_n - error_n AS DOUBLE) / CAST(all_n AS DOUBLE) END AS rate
              FROM (
                SELECT motype, period, sd, st, coalesce(p.matched, 0) AS matched,
                       coalesce(k.known, true) AS known,
                       coalesce(p.matched, 0) * coalesce(k.n, 0) AS all_n,
                       coalesce(f.error_n, 0) AS error_n, coalesce(f.null_n, 0) AS null_n
                FROM event_groups
                LEFT JOIN (SELECT motype, period, sd, st, count(*) AS n,
                                  bool_and(kpi IN ('i1', 'i2', 'i3')) AS known
                           FROM group_kpis GROUP BY ALL) k USING (motype, period, sd, st)
                LEFT JOIN (SELECT motype, period, sd, st, count(*) AS matched
                           FROM group_pairs GROUP BY ALL) p USING (motype, period, sd, st)
                LEFT JOIN (SELECT motype, period, sd, st,
                                  count(*) FILTER (NOT abs(x - y) <= 0.01) AS error_n,
                                  count(*) FILTER (kpi IN ('i1', 'i2', 'i3')
                                                   AND (x IS NULL OR y IS NULL)) AS null_n
                           FROM group_fields GROUP BY ALL) f USING (motype, period, sd, st)))""",
    ),
    "models": (
        [],
        """SELECT DISTINCT c_nationkey || '_' || (c_custkey // 100000) AS motype FROM customer""",
    ),
    "hashes": (
        ["models"],
        """
        SELECT 'MOTYPE:MOTYPEID:SEQUENCE' AS key, motype AS field, 'S' || motype AS value FROM models
        UNION ALL
        SELECT 'ALLMODELMAPPING', motype, n_name || '/' || split_part(motype, '_', 2)
        FROM models JOIN nation ON split_part(motype, '_', 1) = CAST(n_nationkey AS VARCHAR)
        WHERE n_nationkey % 5 <> 4
        UNION ALL
        SELECT 'ALLINDICATORID2SEQ:CONF', 'IND' || p_partkey, CAST(p_partkey AS VARCHAR) FROM part
        UNION ALL
        SELECT 'OBJ:S' || c_nationkey || '_' || (c_custkey // 100000) || ':' || c_custkey, field,
               CASE WHEN field = 'NAME' THEN c_name WHEN field = 'SEGMENT' THEN c_mktsegment
                    WHEN c_custkey % 31 = 0 THEN 'null' WHEN c_custkey % 37 = 0 THEN 'NULL'
                    WHEN c_custkey % 3 = 0 THEN CAST(c_custkey - c_custkey % 600 AS VARCHAR)
                    ELSE CAST(c_custkey AS VARCHAR) END
        FROM (SELECT *, unnest(['NAME', 'SEGMENT', 'MO']) AS field FROM customer)
        WHERE field <> 'MO' OR c_custkey % 41 <> 0 OR c_custkey % 31 = 0 OR c_custkey % 37 = 0
           OR c_custkey % 3 = 0""",
    ),
    "lists": (
        [],
        """
        SELECT c_nationkey || '_' || (c_custkey // 100000) AS motype, c_custkey // 500 AS n,
               string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS ids
        FROM customer GROUP BY ALL""",
    ),
    "texts": (
        ["models", "lists"],
        """
        SELECT 'LIST:' || motype || ':' || n AS key, ids AS value FROM lists
        UNION ALL
        SELECT 'MOTYPE:OBJ:LIST:' || motype,
               string_agg('LIST:' || motype || ':' || n, ',' ORDER BY n) || ',LIST:none,'
        FROM lists GROUP BY motype
        UNION ALL
        SELECT 'MOTYPE:CONFIG:' || motype, 'mo,sd,st,i' || motype || ',,' FROM models
        WHERE NOT starts_with(motype, '3_')""",
    ),
    "part_models": (
        [],
        f"""
        SELECT p_partkey AS part,
               CASE WHEN p_partkey % {2 * _N_IDS} < {_N_IDS}
                    THEN list_extract([{_IDS}], CAST(p_partkey % {2 * _N_IDS} + 1 AS INTEGER))
                    WHEN p_partkey % {2 * _N_IDS} < {2 * _N_IDS - 1}
                    THEN md5(CAST(p_partkey AS VARCHAR)) END AS motype
        FROM part""",
    ),
    "column_listing": (
        [],
        """
        SELECT lower(p_brand) AS table_name,
               CASE p_partkey % 9 WHEN 0 THEN 'k' || p_partkey WHEN 1 THEN 'I' || p_partkey
                    WHEN 2 THEN 'i' || p_partkey || 'a' WHEN 3 THEN 'i_' || p_partkey
                    WHEN 4 THEN CASE WHEN p_partkey % 2 = 0 THEN 'mo' ELSE 'MO' END
                    ELSE 'i' || p_partkey END AS column_name,
               p_partkey AS column_no
        FROM part""",
    ),
    "text_lists": (
        [],
        """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderkey % 11 = 0 THEN repeat(',', o_orderkey % 4)
                    WHEN o_orderkey % 13 <> 0 THEN
                         o_orderstatus || repeat(',', o_orderkey % 4) || ', '
                         || o_orderpriority || repeat(',', o_orderkey % 4) END AS items
        FROM orders""",
    ),
    "export_rows": (
        [],
        """
        SELECT 'orders' AS motype, 'm' AS period,
               CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS sd,
               CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS st,
               o_orderkey AS mo,
               CASE WHEN o_orderkey % 7 <> 0 THEN 'order ' || o_orderkey END AS name,
               CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS INTEGER) END AS r1,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS n745,
               o_orderstatus AS a9,
               CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS isonsite,
               CAST(o_custkey AS INTEGER) AS remark, o_orderstatus AS other
        FROM orders""",
    ),
    "export_lines": (
        ["export_rows"],
        """
        SELECT motype, period, sd, st, mo,
               concat_ws('|', coalesce(CAST(mo AS VARCHAR), ''), coalesce(name, ''),
                         coalesce(CAST(sd AS VARCHAR), ''), coalesce(CAST(st AS VARCHAR), ''),
                         coalesce(CAST(r1 AS VARCHAR), ''), coalesce(n745, ''),
                         coalesce(isonsite, ''), coalesce(CAST(remark AS VARCHAR), ''), '') AS line
        FROM export_rows""",
    ),
}


def with_views(names: list[str], query: str) -> str:
    """``query`` with the views it reads, and those they read, in front."""
    needed: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in needed:
            reads, sql = VIEWS[name]
            for other in reads:
                add(other)
            needed[name] = sql

    for name in names:
        add(name)
    views = ",\n".join(f"{name} AS ({sql})" for name, sql in needed.items())
    return f"WITH {views}\n{query}"
