"""Counts, accuracy rate and verdict of a comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicecheck.functions.text import bracket_list
from slicecheck.operators.pairs import is_duplicated, is_matched
from slicecheck.settings import (
    ENTITY,
    STATUS_FAILED,
    STATUS_MISMATCH,
    STATUS_PASS,
    THRESHOLD,
    written,
)


def summarize(
    cmp: DataFrame, by: Sequence[str], n_kpis: int, threshold: float = THRESHOLD
) -> DataFrame:
    """``all_n, right_n, error_n, rate, status`` of a wide comparison, per slice."""
    totals = cmp.groupBy(*by).agg(*_tallied())
    return _judged(totals, n_kpis, threshold).select(*by, "all_n", "right_n", "error_n", "rate", "status")


def _tallied() -> list[Column]:
    none = F.lit(0).cast("bigint")
    return [
        F.count_if(is_matched()).alias("matched"),
        F.count_if(is_duplicated()).alias("duplicated"),
        F.coalesce(F.sum("n_failed"), none).alias("failed"),
        F.coalesce(F.sum(F.col("bad_new") + F.col("bad_old")), none).alias("bad_keys"),
        F.coalesce(F.sum("n_bad"), none).cast("bigint").alias("error_n"),
    ]


def _judged(totals: DataFrame, n_kpis: int, threshold: float) -> DataFrame:
    counted = totals.withColumn("all_n", F.col("matched") * n_kpis)
    broken = F.col("duplicated") + F.col("failed") + F.col("bad_keys") > 0
    return verdicts(counted, broken, threshold)


def report_details(
    cmp: DataFrame,
    by: Sequence[str],
    n_kpis: int,
    threshold: float = THRESHOLD,
    always: bool = False,
) -> DataFrame:
    """The differing KPIs of each entity, where the verdict is a mismatch or with
    ``always`` wherever there is one: a slice that failed has no details. The comparison runs
    once: entities without a mismatch collapse into counts, the others keep a row, and this
    small table gives both the verdict and the details.
    """
    differing = is_matched() & (F.col("n_bad") > 0)
    kept = [F.when(differing, F.col(c)).alias(c) for c in (ENTITY, "bad")]
    tally = written(cmp.groupBy(*by, *kept).agg(*_tallied()))
    counts = ["matched", "duplicated", "failed", "bad_keys", "error_n"]
    totals = tally.groupBy(*by).agg(*[F.sum(c).alias(c) for c in counts])
    reported = F.col("status") != STATUS_FAILED if always else F.col("status") == STATUS_MISMATCH
    verdict = _judged(totals, n_kpis, threshold).where(reported)
    details = tally.where(F.col(ENTITY).isNotNull()).select(*by, ENTITY, bracket_list(F.col("bad")).alias("fields"))
    if by:
        return details.join(verdict.select(*by), list(by), "left_semi")
    return details.where(verdict.exists())


def verdicts(counted: DataFrame, broken: Column, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``right_n, rate, status`` to rows with ``matched, all_n, error_n``.

    A slice that cannot be judged has status 2. The rate is null, not NaN, where
    nothing was compared: NaN would rank above any threshold.
    """
    rated = counted.withColumn("right_n", F.col("all_n") - F.col("error_n")).withColumn(
        "rate", F.try_divide(F.col("right_n").cast("double"), F.col("all_n").cast("double"))
    )
    failed = broken | (F.col("matched") == 0)
    return rated.withColumn(
        "status",
        F.when(F.coalesce(failed, F.lit(True)), STATUS_FAILED)
        .when(F.col("rate") > threshold, STATUS_PASS)
        .otherwise(STATUS_MISMATCH),
    )
