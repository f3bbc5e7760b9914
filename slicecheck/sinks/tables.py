"""Tables that only grow, such as task sheets. For outputs of a run see ``sinks.runs``."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    df.write.mode("append").format(file_format).save(path)

