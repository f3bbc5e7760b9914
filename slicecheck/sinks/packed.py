"""Packed text: one heading per slice, then one line per row with ``|`` between cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicecheck.functions.names import cell_type
from slicecheck.operators.batches import number_rows
from slicecheck.settings import ENTITY, IDS_PER_CHUNK, SLICE

# Fixed values of the format.
CELL_SEPARATOR = "|"
LINE_END = "\r\n"
# Types of the columns of a slice.
SLICE_TYPES = {"motype": "string", "period": "string", "sd": "int", "st": "int"}


def exported_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if cell_type(c) != "drop"]


def heading(columns: Sequence[str]) -> str:
    return CELL_SEPARATOR.join(exported_columns(columns))


def packed_line(columns: Sequence[str]) -> Column:
    """A row as text. Nulls, and columns whose name tells no type, give empty cells."""
    cells = [
        F.coalesce(F.col(c).cast(cell_type(c)).cast("string"), F.lit(""))
        if cell_type(c)
        else F.lit("")
        for c in exported_columns(columns)
    ]
    return F.concat_ws(CELL_SEPARATOR, *cells)


def packed_lines(df: DataFrame, columns: Sequence[str], by: Sequence[str] = SLICE) -> DataFrame:
    """``by, line_no, mo, line``: a heading (0) for each slice that has rows, and its rows (1)."""
    headings = (
        df.select(*by)
        .distinct()
        .select(
            *by,
            F.lit(0).alias("line_no"),
            F.lit(None).cast(df.schema[ENTITY].dataType).alias("_order"),
            F.lit(heading(columns)).alias("line"),
        )
    )
    rows = df.select(
        *by,
        F.lit(1).alias("line_no"),
        F.col(ENTITY).alias("_order"),
        packed_line(columns).alias("line"),
    )
    # Headings come first on purpose, see write_packed.
    return headings.unionAll(rows)


def write_packed(
    df: DataFrame,
    columns: Sequence[str],
    path: str,
    by: Sequence[str] = SLICE,
    compression: str = "gzip",
) -> None:
    """Writes one folder per slice. Its files in name order make up one text: the
    heading, then all rows.

    Rows are brought together by slice with a rebalancing shuffle: adaptive
    execution merges small slices into one task and splits a slice that is too
    large for one, over several files. It splits by runs of map tasks, and the
    headings are the first branch of the union, so a heading is always in its
    slice's first file, where the sort puts it on top.
    """
    (
        packed_lines(df, columns, by)
        .hint("rebalance", *[F.col(c) for c in by])
        .sortWithinPartitions(*by, "line_no", "_order")
        .select(*by, "line")
        .write.partitionBy(*by)
        .option("lineSep", LINE_END)
        .option("compression", compression)
        .text(path)
    )


def read_packed(
    spark: SparkSession, path: str, columns: Sequence[str], by: dict[str, str] = SLICE_TYPES
) -> DataFrame:
    """The lines of a packed export without headings, with the slice of each. Slice columns
    have the types of ``by``, so that an id like ``00123`` stays what it is. Each slice has
    one heading; of lines that read the same, one per slice is taken for it.
    """
    schema = ", ".join(["value string", *[f"{name} {kind}" for name, kind in by.items()]])
    lines = spark.read.schema(schema).option("lineSep", LINE_END).text(path)
    is_heading = F.col("value") == heading(columns)
    alike = lines.where(is_heading).groupBy("value", *by).agg(F.count("*").alias("n"))
    # As rows again, one fewer. Nothing is left as a rule.
    more = alike.where("n > 1").select(
        "value", *by, F.explode(F.sequence(F.lit(2).cast("bigint"), F.col("n"))).alias("i")
    )
    return lines.where(~is_heading).unionByName(more.drop("i"))


def packed_blobs(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = SLICE,
    size: int = IDS_PER_CHUNK,
) -> DataFrame:
    """``by, part, text``: the packed rows as texts of at most ``size`` rows, each
    with its own heading, for stores that take whole values. Equal rows travel as
    one with a count, so neither a large slice nor many copies of a row end up in
    one task.
    """
    rows = (
        df.select(*by, F.col(ENTITY).alias("_order"), packed_line(columns).alias("line"))
        .groupBy(*by, "_order", "line")
        .agg(F.count("*").alias("copies"))
    )
    # A row and its copies may reach over several parts.
    reached = F.expr(f"sequence(pos div {size}, (pos + copies - 1) div {size})")
    placed = number_rows(rows, by, ["_order", "line"], "copies").select(
        "*", F.explode(reached).alias("part")
    )
    inside = F.least(F.col("pos") + F.col("copies"), (F.col("part") + 1) * size) - F.greatest(
        F.col("pos"), F.col("part") * size
    )
    parts = placed.groupBy(*by, "part").agg(
        F.array_sort(
            F.collect_list(F.struct("pos", F.col("line"), inside.cast("int").alias("n")))
        ).alias("rows")
    )
    lines = F.flatten(F.transform("rows", lambda row: F.array_repeat(row["line"], row["n"])))
    text = F.array_join(F.concat(F.array(F.lit(heading(columns))), lines), LINE_END)
    return parts.select(*by, "part", F.concat(text, F.lit(LINE_END)).alias("text"))


def blob_lines(blobs: DataFrame, by: Sequence[str] = SLICE) -> DataFrame:
    """``by, part, line_no, line``: the lines of ``packed_blobs`` again, from 1, without the
    headings. Those go by place, so a line that reads like one stays. Cells must not hold the
    line end. A null text has no lines."""
    ends = F.split("text", LINE_END)
    lines = F.slice(ends, F.lit(2), F.greatest(F.size(ends) - 2, F.lit(0)))
    return blobs.select(*by, "part", F.posexplode(lines).alias("line_no", "line")).withColumn(
        "line_no", F.col("line_no") + 1
    )
