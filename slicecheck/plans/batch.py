"""All check tasks in one distributed job.

What the tasks ask for is applied before anything is shuffled: the days of the task
list, its slices, the KPIs that some task checks, and the entities of tasks that list
some. The two fact tables are then paired by (slice, entity) once. What any task needs to
know about a slice is folded into the *tally*: clean entities collapse into one row per
slice, map-side, and only entities with a finding keep a row. The tasks' KPI lists are
applied to that small table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicecheck.functions.text import bracket_list, kpi_name
from slicecheck.operators.fingerprints import part_equal
from slicecheck.operators.pairs import (
    WORD,
    entity_key,
    mismatch_words,
    pair_differences,
    words_of,
)
from slicecheck.plans.summary import verdicts
from slicecheck.plans.tasks import (
    listed_entities,
    listed_kpis,
    outcome_rows,
    result_rows,
    running_rows,
    task_groups,
)
from slicecheck.settings import (
    BAD_KEY,
    ENTITY,
    SLICE,
    STATUS_FAILED,
    STATUS_MISMATCH,
    THRESHOLD,
    TOLERANCE,
    passing_tables,
    written,
)
from slicecheck.sinks.runs import Attempt, Runs
from slicecheck.sources.quarantine import Copy, failed_models, fault_rows, held_kpis
from slicecheck.sources.tables import Catalog, facts_of, value_columns

BY = ["slice_no"]
# A slice table of so many rows is sent to all tasks.
SENT_SLICES = 10_000
# Rows of a slice that are joined under one key, and how many slices may have more.
SALT_ROWS = 2_000_000
MOST_HOT = 5_000
# What became of the keys of a slice, next to the matched ones.
KEY_COUNTS = ["only_new", "only_old", "null_keys", "bad_keys"]
RESULT = [
    *SLICE, "matched", "all_n", "right_n", "error_n", "null_n", "rate", "status", *KEY_COUNTS,
]


@dataclass(frozen=True)
class Batch:
    """``results``: one row per slice; ``details``: one row per entity with mismatches."""

    results: DataFrame
    details: DataFrame


@dataclass(frozen=True)
class Asked:
    """What the tasks ask for as a whole: their days, the places of the KPIs that any of
    them checks, and whether any is restricted to some entities."""

    first_day: int | None
    last_day: int | None
    places: list[int]
    restricted: bool


def reconcile_batch(
    tasks: DataFrame,
    new: DataFrame,
    old: DataFrame,
    kpis: Sequence[str],
    catalog: Catalog | None = None,
    old_catalog: Catalog | None = None,
    tol: float = TOLERANCE,
    threshold: float = THRESHOLD,
    always: bool = False,
    materialize: bool = False,
    failed: DataFrame | None = None,
    fingerprints: bool = False,
) -> Batch:
    """Checks every slice the tasks name. ``new`` and ``old`` hold ``SLICE, mo`` and
    ``kpis``. Models that differ in their KPIs share these columns: ``catalog`` tells
    the KPI that each model keeps in the first, the second and so on. Without it the
    columns are the KPIs, for every model. ``old_catalog`` tells what the old copy has:
    a slice that checks a KPI which either copy lacks has failed. ``failed`` lists models
    (``motype, period``) whose tables cannot be judged. ``materialize`` writes the tally and
    the judgement once, for callers that use both outputs. ``fingerprints`` compares digests
    of slices first and pairs only rows where they differ; that reads the facts twice and
    pays where most slices are equal.
    """
    # Used in several places below: one small row per slice, fixed once.
    groups = written(check_plans(tasks, kpis, catalog, old_catalog, failed))
    asked = asked_for(groups)
    used = [kpis[place] for place in asked.places]
    groups = groups.withColumn("places", _renumbered(asked.places))
    new, old = route([new, old], groups, asked, used)
    tally = (tally_by_fingerprint if fingerprints else tally_slices)(new, old, used, tol)
    if materialize:
        tally = written(tally)
    judged = judge(groups, tally, used, threshold)
    if materialize:
        judged = written(judged)
    return Batch(judged.select(*RESULT), mismatch_details(judged, tally, used, always))


def reconcile_tables(
    tasks: DataFrame, new: Copy, old: Copy, **options
) -> tuple[Batch, DataFrame]:
    """Checks two copies of which some tables may be unusable, and gives their faults as a
    table: the tasks on these fail, with status 2, and no others."""
    spark = tasks.sparkSession
    faults = written(fault_rows(spark, [new, old]))
    facts = [facts_of(spark, copy.tables, new.listed) for copy in (new, old)]
    columns = value_columns(new.listed)
    catalogs = new.listed, held_kpis(new, old)
    return reconcile_batch(tasks, *facts, columns, *catalogs, failed=failed_models(faults), **options), faults


def check_plans(
    tasks: DataFrame,
    kpis: Sequence[str],
    catalog: Catalog | None = None,
    old_catalog: Catalog | None = None,
    failed: DataFrame | None = None,
) -> DataFrame:
    """One row per slice: its number, ``labels`` of the KPIs to check as listed,
    their ``places`` among the value columns, and whether the slice is ``known`` (has
    a model with all these KPIs in both copies) and ``restricted`` (to listed entities).
    """
    groups = task_groups(tasks)
    if catalog is None:
        names = F.array(*[F.lit(k) for k in kpis]).cast("array<string>")
        groups = groups.withColumn("kpis", names).withColumn("held", names)
    else:
        both = catalog if old_catalog is None else old_catalog
        models = tasks.sparkSession.createDataFrame(
            [(*model, names, both.get(model)) for model, names in catalog.items()],
            "motype string, period string, kpis array<string>, held array<string>",
        )
        groups = groups.join(models, ["motype", "period"], "left")
    sound = F.lit(True)
    if failed is not None:
        groups = groups.join(failed.withColumn("_failed", F.lit(True)), ["motype", "period"], "left")
        sound = F.col("_failed").isNull()
    planned = groups.withColumn("labels", listed_kpis(F.col("indicators"), F.col("kpis")))
    place = F.transform(
        "labels", lambda label: (F.array_position("kpis", kpi_name(label)) - 1).cast("int")
    )
    known = F.forall("labels", lambda label: F.array_contains("held", kpi_name(label)))
    return planned.withColumn("places", place).select(
        *SLICE,
        F.monotonically_increasing_id().alias("slice_no"),
        "labels",
        "places",
        F.coalesce(F.forall("places", lambda p: p >= 0) & known & sound, F.lit(False)).alias("known"),
        F.col("moentities").isNotNull().alias("restricted"),
        "moentities",
    )


def asked_for(groups: DataFrame) -> Asked:
    """One row, and one list with an entry per value column at most."""
    row = groups.agg(
        F.min("sd").alias("lo"),
        F.max("sd").alias("hi"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("places")))).alias("places"),
        F.coalesce(F.max("restricted"), F.lit(False)).alias("restricted"),
    ).first()
    return Asked(row.lo, row.hi, [p for p in row.places if p is not None and p >= 0], row.restricted)


def route(
    facts: Sequence[DataFrame], groups: DataFrame, asked: Asked, kpis: Sequence[str]
) -> list[DataFrame]:
    """The facts that tasks ask for, ``slice_no, mo`` and the KPIs. Only these columns are
    read. A slice table of at most ``SENT_SLICES`` rows, which is counted, is sent to the
    facts. A larger one is joined by shuffle; there a slice with very many rows is dealt out
    over salts, as many as its counted size calls for, and its row in the slice table is
    copied to each. A slice is one number from here on.
    """
    days = F.lit(False)
    if asked.first_day is not None:
        days = F.col("sd").between(asked.first_day, asked.last_day)
    # The range holds for every slice. Only with a filter on the small side does Spark
    # hand its days to the scan of the large one.
    slices = groups.where(days).select(*SLICE, "slice_no", "restricted")
    salts = None
    if groups.count() <= SENT_SLICES:
        slices = F.broadcast(slices)
    else:
        salts = hot_slices(facts, days)
    routed = []
    for side in facts:
        entity = [c for c in (ENTITY, BAD_KEY) if c in side.columns]
        rows = side.where(days).select(*SLICE, *entity, *kpis)
        if salts is None:
            rows = rows.join(slices, SLICE)
        else:
            rows = salted(rows, entity_key(side), slices, salts)
        if asked.restricted:
            listed = listed_entities(groups, BY).distinct()
            listed = listed.select(
                F.col("slice_no").alias("_no"), F.col(ENTITY).alias("_mo"), F.lit(True).alias("_listed")
            )
            same = (F.col("slice_no") == F.col("_no")) & (entity_key(side) == F.col("_mo"))
            rows = rows.join(listed, same, "left").where("NOT restricted OR _listed")
        routed.append(rows.select(*BY, *entity, *kpis))
    return routed


def hot_slices(facts: Sequence[DataFrame], days: Column) -> DataFrame:
    """``SLICE, salts`` of the slices with more than ``SALT_ROWS`` rows on both sides together;
    at most ``MOST_HOT``, so that they may be sent to every task."""
    rows = reduce(DataFrame.unionAll, [side.where(days).select(*SLICE) for side in facts])
    sizes = written(rows.groupBy(*SLICE).agg(F.count("*").alias("_n")))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    limit = max(SALT_ROWS, -(-total // MOST_HOT))
    hot = sizes.where(F.col("_n") > limit)
    return hot.select(*SLICE, F.ceil(F.col("_n") / limit).cast("int").alias("salts"))


def salted(rows: DataFrame, key: Column, slices: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` joined to their slices by shuffle, hot slices by part of their keys."""
    part = F.pmod(F.xxhash64(key, F.monotonically_increasing_id()), F.col("salts")).cast("int")
    dealt = rows.join(F.broadcast(hot), SLICE, "left").withColumn("_salt", F.coalesce(part, F.lit(0))).drop("salts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)
    copied = slices.join(F.broadcast(hot), SLICE, "left").withColumn("_salt", F.explode(copies)).drop("salts")
    return dealt.join(copied, [*SLICE, "_salt"]).drop("_salt")


def tally_slices(
    new: DataFrame, old: DataFrame, kpis: Sequence[str], tol: float = TOLERANCE
) -> DataFrame:
    """``slice_no, kind, mo``, bits per KPI and the number ``n`` of entities they hold
    for: ``err_`` (mismatch), ``null_`` (a side is null) and ``fail_`` (no number).
    ``kind`` tells what became of the key; ``null_keys`` and ``bad_keys`` count rows
    without a usable one. ``mo`` is given for entities with a mismatch only, so that all
    others collapse by what was found. Rows stay narrow, however many KPIs there are.
    """
    pairs = pair_differences(new, old, [*BY, ENTITY], kpis)
    err, null, fail = (words_of(flag, kpis) for flag in ("err", "null", "fail"))
    kind = f"""CASE WHEN {ENTITY} IS NULL THEN 'none' WHEN n_new > 1 OR n_old > 1 THEN 'duplicated'
        WHEN n_old = 0 THEN 'only_new' WHEN n_new = 0 THEN 'only_old' ELSE 'matched' END AS kind"""
    # Of keys that are not matched nothing else counts.
    found = pairs.select("*", *mismatch_words(kpis, tol)).selectExpr(
        *BY,
        ENTITY,
        kind,
        "bad_new + bad_old AS bad",
        "n_new + n_old AS rows",
        *[f"IF({ENTITY} IS NOT NULL AND n_new = 1 AND n_old = 1, {w}, 0L) AS {w}" for w in (*err, *null, *fail)],
    )
    any_bad = " OR ".join(f"{w} <> 0" for w in err) or "false"
    return found.groupBy(
        *BY,
        "kind",
        F.expr(f"IF({any_bad}, {ENTITY}, NULL) AS {ENTITY}"),
        *(*err, *null, *fail),
    ).agg(
        F.count("*").alias("n"),
        F.expr("sum(IF(kind = 'none', rows - bad, 0L)) AS null_keys"),
        F.expr("sum(IF(kind = 'none', bad, 0L)) AS bad_keys"),
    )


def tally_by_fingerprint(
    new: DataFrame, old: DataFrame, kpis: Sequence[str], tol: float = TOLERANCE
) -> DataFrame:
    """The same as :func:`tally_slices`; rows of parts that are equal in both copies are
    counted where they are read and never reach the shuffle by key."""
    parted = part_equal(new, old, BY[0], kpis)
    paired = tally_slices(parted.new, parted.old, kpis, tol)
    none = F.lit(0).cast("bigint")
    alike = parted.equal.select(
        *BY,
        F.lit("matched").alias("kind"),
        F.lit(None).cast("bigint").alias(ENTITY),
        *[none.alias(w) for w in words_of("err", kpis)],
        *words_of("null", kpis),
        *[none.alias(w) for w in words_of("fail", kpis)],
        "n",
        none.alias("null_keys"),
        none.alias("bad_keys"),
    )
    return paired.unionByName(alike)


def judge(
    groups: DataFrame,
    tally: DataFrame,
    kpis: Sequence[str],
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per slice, also for slices without any data: the columns of its check
    plan, its counts, rate and status.
    """
    kinds = {"matched": "matched", "duplicates": "duplicated", "only_new": "only_new", "only_old": "only_old"}
    sums = {name: f"sum(IF(kind = '{kind}', n, 0L))" for name, kind in kinds.items()}
    sums |= {name: f"sum({name})" for name in ("null_keys", "bad_keys")}
    sums |= {
        f"{flag}_of_{n}": f"sum(IF(getbit({flag}_{n // WORD}, {n % WORD}) = 1, n, 0L))"
        for flag in ("err", "null", "fail")
        for n in range(len(kpis))
    }
    totals = tally.groupBy(*BY).agg(*[F.expr(f"{text} AS {name}") for name, text in sums.items()])
    counted = (
        groups.join(totals, BY, "left")
        .fillna(0, subset=list(sums))
        .select(
            *groups.columns,
            "matched",
            "duplicates",
            *KEY_COUNTS,
            _over_list("fail_of", kpis).alias("failed"),
            _over_list("null_of", kpis).alias("null_n"),
            (F.col("matched") * F.coalesce(F.size("labels"), F.lit(0))).alias("all_n"),
            _over_list("err_of", kpis).alias("error_n"),
        )
    )
    broken = F.expr("NOT known OR duplicates > 0 OR failed > 0 OR bad_keys > 0")
    return verdicts(counted, broken, threshold)


def mismatch_details(
    judged: DataFrame, tally: DataFrame, kpis: Sequence[str], always: bool = False
) -> DataFrame:
    """The differing KPIs of each entity, in the order of the slice's KPI list; for
    slices judged as mismatching, or with ``always`` for all that could be judged.
    """
    reported = F.col("status") != STATUS_FAILED if always else F.col("status") == STATUS_MISMATCH
    slices = judged.where(reported).select(*SLICE, *BY, "labels", "places")
    words = F.array(*words_of("err", kpis)).cast("array<bigint>")
    rows = (
        tally.where(F.col(ENTITY).isNotNull())
        .select(*BY, ENTITY, words.alias("words"))
        .join(slices, BY)
    )

    def is_bad(place: Column) -> Column:
        word = F.get("words", F.floor(place / WORD).cast("int"))
        return F.getbit(word, place % WORD) == 1

    bad = F.filter("labels", lambda _, n: is_bad(F.get("places", n)))
    return (
        rows.withColumn("bad", bad)
        .where(F.size("bad") > 0)
        .select(*SLICE, ENTITY, bracket_list(F.col("bad")).alias("fields"))
    )


def run_batch(
    tasks: DataFrame,
    new: DataFrame,
    old: DataFrame,
    kpis: Sequence[str],
    run: str,
    ledger: str,
    task_results: str,
    details: str,
    at: Column | None = None,
    manifests: str | None = None,
    **options,
) -> Attempt:
    """Runs a batch and adds to three tables: the ledger (a row when tasks start and
    one when they end), the task results and the mismatch details. That tasks are running is
    seen at once; all results of the run are seen together, from its commit on (see
    ``sinks.runs``; read the tables with :func:`runs_of`). A run that is repeated under its
    name is a new attempt, and what the former one wrote counts until the new one has ended.
    The task list is fixed at the start: it may be read from the ledger that is written to.
    Tables in between are removed at the end.
    """
    spark = tasks.sparkSession
    runs = runs_of(spark, ledger, manifests)
    attempt = runs.begin(run)
    with passing_tables(spark):
        tasks = written(tasks)
        runs.write(running_rows(tasks, at), ledger, attempt, seq=0)
        batch = reconcile_batch(tasks, new, old, kpis, materialize=True, **options)
        runs.write(batch.details, details, attempt)
        runs.write(result_rows(batch.results, tasks, at), task_results, attempt)
        runs.write(outcome_rows(batch.results, tasks, at), ledger, attempt, seq=1)
        runs.commit(attempt, [ledger, task_results, details])
    return attempt


def runs_of(spark: SparkSession, ledger: str, manifests: str | None = None) -> Runs:
    """The runs of a ledger; their manifests lie beside it unless told otherwise."""
    return Runs(spark, manifests or f"{ledger.rstrip('/')}-runs")


def _renumbered(places: list[int]) -> Column:
    """Places among the columns that are used at all; -1 for an unknown KPI stays."""
    used = F.array(*[F.lit(p) for p in places]).cast("array<int>")
    return F.transform("places", lambda p: (F.array_position(used, p) - 1).cast("int"))


def _over_list(prefix: str, kpis: Sequence[str]) -> Column:
    """Sum of a count over the slice's KPI list; a KPI listed twice counts twice."""
    counts = F.array(*[f"{prefix}_{n}" for n in range(len(kpis))]).cast("array<bigint>")
    total = F.aggregate(
        "places",
        F.lit(0).cast("bigint"),
        lambda total, place: total + F.coalesce(F.get(counts, place), F.lit(0)),
    )
    return F.coalesce(total, F.lit(0)).cast("bigint")
