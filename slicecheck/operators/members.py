"""Membership in a fixed set of ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicecheck.functions.models import LOGICAL_MODEL_IDS


def set_members(
    df: DataFrame, column: str = "motype", ids: Sequence[str] = LOGICAL_MODEL_IDS
) -> DataFrame:
    """Rows whose id is in the set. The set is a short constant, so it becomes a
    hash lookup inside the scan's filter and needs no join.
    """
    return df.where(F.col(column).isin(*ids))


def set_nonmembers(
    df: DataFrame, column: str = "motype", ids: Sequence[str] = LOGICAL_MODEL_IDS
) -> DataFrame:
    """Rows whose id is not in the set; a null id is in no set."""
    return df.where(~F.coalesce(F.col(column).isin(*ids), F.lit(False)))
