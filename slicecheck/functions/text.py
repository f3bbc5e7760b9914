"""Text and time expressions, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_list(text: Column) -> Column:
    """Comma list to array. Trailing empty items are dropped, inner ones kept;
    an empty text is one empty item, only commas are no item, null stays null.
    """
    no_items = F.array().cast("array<string>")
    return F.when(text.rlike("^,+$"), no_items).otherwise(
        F.split(F.regexp_replace(text, ",+$", ""), ",")
    )


def bracket_list(items: Column) -> Column:
    """Array to text in the form ``[i1, i2]``."""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def stamp_long(instant: Column) -> Column:
    """Instant as a ``yyyyMMddHHmmss`` number."""
    return F.date_format(instant, "yyyyMMddHHmmss").cast("bigint")


def day_int(instant: Column) -> Column:
    """Day of an instant as a ``yyyyMMdd`` number."""
    return (F.year(instant) * 10000 + F.month(instant) * 100 + F.dayofmonth(instant)).cast("int")


def same_text(left: Column, right: Column | str) -> Column:
    """Equality ignoring case; false where the left side is null."""
    right = F.lit(right) if isinstance(right, str) else right
    return F.coalesce(F.lower(left) == F.lower(right), F.lit(False))


def indicator_column(sequence: Column) -> Column:
    """Column name of an indicator, from its sequence number."""
    return F.concat(F.lit("I"), sequence)


def kpi_name(label: Column) -> Column:
    """Column a listed KPI label stands for; labels may carry blanks or upper case."""
    return F.lower(F.trim(label))
