"""Reading the tables, and work on Arrow batches in tasks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slicecheck.settings import written

# Fixed value: a word of the contracts is a run of anything but these.
WORD = r"[^\x20\x09-\x0D]+"

# A batch that enters Python has at most so many rows, and is worked on in pieces of
# about so many characters, so that memory does not depend on how long texts are.
BATCH_ROWS = 1000
PIECE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, compressed well."""
    return written(df, "zstd")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(df[column], F.lit(""))


def bounded_sample(rows: DataFrame, doc_id: str, limit: int) -> DataFrame:
    """``limit`` rows, the first by a hash of ``doc_id``, or all if there are fewer. Rows far
    down that order are left out before it is made, so that what tasks hand on together is
    about ``limit`` rows, not so many from each."""
    place = F.pmod(F.xxhash64(doc_id), F.lit(1 << 30))
    n = rows.count()
    if n > limit:
        # Ten deviations more than are needed.
        share = (limit + 10 * limit**0.5) / n
        rows = rows.where(place < int(share * (1 << 30)))
    return rows.orderBy(place, doc_id).limit(limit)


def map_texts(
    df: DataFrame,
    function: Callable[[list[str], pa.RecordBatch], dict],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """``function`` gets the texts of a piece (null as empty) and its rows, and returns
    the columns of ``schema``. Memory is bounded by the piece, not by the partition.
    """
    spark = df.sparkSession
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    ship(spark)
    arrow = to_arrow(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for low, high in pieces(texts):
                columns = function(texts[low:high], batch.slice(low, high - low))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def ship(spark: SparkSession) -> None:
    """Python workers find this package where it lies, if it is not installed for them."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def to_arrow(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def pieces(texts: list[str], chars: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    low = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield low, i
            low, size = i, 0
        size += len(text) + 64
    if low < len(texts):
        yield low, len(texts)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Offsets of ragged rows of these lengths, with the end of the last one."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def gather(flat: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the ragged rows in ``flat``, those numbered ``rows`` one after the other, and
    the offsets of the result."""
    lengths = starts[rows + 1] - starts[rows]
    out = starts_of(lengths)
    places = np.arange(out[-1]) + np.repeat(starts[rows] - out[:-1], lengths)
    return flat[places], out
