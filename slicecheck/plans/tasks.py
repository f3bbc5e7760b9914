"""Check tasks: generating, grouping, fanning results out, and the ledger."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicecheck.functions.text import day_int, kpi_name, split_list, stamp_long
from slicecheck.operators.batches import number_rows
from slicecheck.settings import (
    ENTITY,
    KEYS_PER_BATCH,
    SLICE,
    STATUS_FAILED,
    STATUS_RUNNING,
)

# The slot for which task sheets are generated unless told otherwise.
SHEET_PERIOD = "h"
SHEET_DAY = 20190926
SHEET_TIME = 0


def generate_tasks(
    models: DataFrame,
    period: str = SHEET_PERIOD,
    slots: Iterable[tuple[int, int]] = ((SHEET_DAY, SHEET_TIME),),
) -> DataFrame:
    """One task sheet per row of the model list and slot."""
    # One literal, however many slots there are.
    rows = json.dumps([{"start_day": int(d), "start_time": int(t)} for d, t in slots])
    slot = F.from_json(F.lit(rows), "array<struct<start_day:int,start_time:int>>")
    return _sheets(models.select("motype", F.lit(period).alias("period"), F.inline(slot)))


def generate_tasks_range(
    models: DataFrame, first_day: Column, last_day: Column, times: Column, period: str = SHEET_PERIOD
) -> DataFrame:
    """One task sheet per row of ``models``, day of a range (dates) and slot of the day (an
    array of ints). Days and times are columns of ``models``, or literals."""
    days = F.explode(F.sequence(first_day, last_day, F.expr("interval 1 day"))).alias("day")
    dated = models.select("motype", F.lit(period).alias("period"), days, times.alias("times"))
    return _sheets(
        dated.select("motype", "period", day_int(F.col("day")).alias("start_day"), F.explode("times").alias("start_time"))
    )


def _sheets(slots: DataFrame) -> DataFrame:
    """The day is entered in three further date fields of the sheet as well."""
    return slots.select("*", *[F.col("start_day").alias(f"sheet_day_{n}") for n in (1, 2, 3)])


def by_slice(tasks: DataFrame) -> DataFrame:
    """Tasks with the columns of the slice they check. The period is lower-cased as
    in table names.
    """
    return tasks.select(
        "task_id",
        "motype",
        F.lower("period").alias("period"),
        F.col("start_day").alias("sd"),
        F.col("start_time").alias("st"),
        "indicators",
        "moentities",
    )


def task_groups(tasks: DataFrame) -> DataFrame:
    """One row per slice: its number of tasks and its first task, which decides on
    the KPIs and entities to check. Task lists stay in row form, see
    :func:`group_task_ids` and :func:`fan_out`.
    """
    first = F.min_by(F.struct("indicators", "moentities"), "task_id")
    return (
        by_slice(tasks)
        .groupBy(*SLICE)
        .agg(
            F.count("*").alias("n_tasks"),
            F.min("task_id").alias("first_task_id"),
            first.alias("first"),
        )
        .select(*SLICE, "n_tasks", "first_task_id", "first.indicators", "first.moentities")
    )


def group_task_ids(tasks: DataFrame, size: int = KEYS_PER_BATCH) -> DataFrame:
    """The task ids of each slice as ordered lists of at most ``size`` ids, so that a
    slice with very many tasks does not become one huge cell.
    """
    numbered = number_rows(
        by_slice(tasks).select(*SLICE, "task_id").distinct(), SLICE, ["task_id"]
    )
    chunk = F.expr(f"pos div {size}").alias("chunk")
    return numbered.groupBy(*SLICE, chunk).agg(
        F.array_sort(F.collect_list("task_id")).alias("task_ids")
    )


def fan_out(results: DataFrame, tasks: DataFrame) -> DataFrame:
    """The result of each slice for every task that asked for it. Tasks that name no
    proper slice have a result, too, so nulls count as equal.
    """
    of_slice = results.withColumnsRenamed({c: f"_{c}" for c in SLICE})
    same_slice = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SLICE]
    joined = by_slice(tasks).select(*SLICE, "task_id").join(of_slice, same_slice)
    return joined.drop(*[f"_{c}" for c in SLICE])


def listed_kpis(indicators: Column, default: Column) -> Column:
    """Labels of the KPIs to check. The entity key may be listed but is never checked."""
    labels = F.coalesce(split_list(indicators), default)
    return F.filter(labels, lambda label: kpi_name(label) != ENTITY)


def task_kpi_list(tasks: DataFrame, kpis: list[str]) -> DataFrame:
    """One row per task and KPI to check."""
    default = F.array(*[F.lit(k) for k in kpis]).cast("array<string>")
    labels = listed_kpis(F.col("indicators"), default)
    return tasks.select("task_id", F.posexplode(labels).alias("pos", "kpi"))


def listed_entities(groups: DataFrame, by: Sequence[str] = SLICE) -> DataFrame:
    """``by, mo`` of all slices restricted to some entities."""
    items = groups.where(F.col("moentities").isNotNull()).select(
        *by, F.explode(split_list(F.col("moentities"))).alias("item")
    )
    return items.select(*by, F.trim("item").try_cast("bigint").alias(ENTITY)).dropna(
        subset=[ENTITY]
    )


def running_rows(tasks: DataFrame, at: Column | None = None) -> DataFrame:
    """Ledger rows of tasks that are being run."""
    none = F.lit(None).cast("bigint")
    return tasks.select(
        "task_id",
        F.lit(0).alias("seq"),
        F.lit(STATUS_RUNNING).alias("status"),
        none.alias("all_n"),
        none.alias("right_n"),
        none.alias("error_n"),
        _now(at).alias("stamp"),
    )


def result_rows(results: DataFrame, tasks: DataFrame, at: Column | None = None) -> DataFrame:
    """One result per task. A task that failed has no counts and no finish time."""
    judged = F.col("status") != STATUS_FAILED
    return fan_out(results, tasks).select(
        "task_id",
        "status",
        *[F.when(judged, F.col(c)).alias(c) for c in ("all_n", "right_n", "error_n")],
        F.when(judged, _now(at)).alias("finish_time"),
    )


def outcome_rows(results: DataFrame, tasks: DataFrame, at: Column | None = None) -> DataFrame:
    """Ledger rows of finished tasks."""
    return result_rows(results, tasks, at).select(
        "task_id",
        F.lit(1).alias("seq"),
        "status",
        "all_n",
        "right_n",
        "error_n",
        _now(at).alias("stamp"),
    )


def latest_status(ledger: DataFrame) -> DataFrame:
    """The last ledger row of each task. The ledger is only appended to; a maximum
    combines map-side, so tasks with a long history cost no more than others. Stamps are
    seconds: rows of one attempt at a run stay together, in the order in which attempts began,
    then by name and number. A run that has begun again and has no outcome yet is running,
    whatever the attempt before came to; one that begins in the second another ends comes
    after it.
    """
    row = F.struct(*[c for c in ledger.columns if c != "task_id"]).alias("row")
    of_run = [c for c in ("run", "attempt") if c in ledger.columns]
    attempts = ledger.groupBy("task_id", *of_run).agg(
        F.min("stamp").alias("began"),
        F.max_by(row, F.struct("seq", "stamp") if of_run else F.struct("stamp", "seq")).alias("row"),
    )
    order = F.struct("began", *of_run)
    last = attempts.groupBy("task_id").agg(F.max_by("row", order).alias("last"))
    return last.select("task_id", "last.*")


def _now(at: Column | None) -> Column:
    return stamp_long(F.current_timestamp() if at is None else at)
