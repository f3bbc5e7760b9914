"""Rules on table and column names, applied while a plan is built."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicecheck.settings import ENTITY, KPI_PATTERN

# The cell type of an exported column follows from its name.
# The first pattern that fits the whole name decides; "drop" leaves the column
# out, and a name that fits none keeps its heading over empty cells.
CELL_TYPES = [
    ("(?i:mo|name)", "string"),
    ("r.*", "int"),
    ("n.*", "string"),
    ("a.*", "drop"),
    ("(?i:sd|st)", "int"),
    ("(?i:sdt)", "bigint"),
    ("(?i:isonsite)", "string"),
    ("[ik].*", "double"),
    (".*(bh|wh|mh).*", "double"),
]


def table_name(motype: str, period: str) -> str:
    """Name of the table that holds one model at one granularity."""
    return f"t_{motype}_{period.lower()}"


def is_kpi(name: str, pattern: str = KPI_PATTERN) -> bool:
    return re.match(pattern, name) is not None


def kpi_columns(source: DataFrame | Iterable[str], pattern: str = KPI_PATTERN) -> list[str]:
    """KPI columns of a table or a list of names, in their order. The entity key is not one."""
    names = source.columns if isinstance(source, DataFrame) else source
    return [name for name in names if is_kpi(name, pattern)]


def catalog_columns(names: Column, pattern: str = KPI_PATTERN, entity: str = ENTITY) -> Column:
    """The same choice over a column of names, with the entity key kept."""
    return names.rlike(pattern) | (F.lower(names) == entity)


def cell_type(name: str) -> str | None:
    """Type in which an exported column is written, "drop", or None for empty cells."""
    return next((kind for rule, kind in CELL_TYPES if re.fullmatch(rule, name)), None)
