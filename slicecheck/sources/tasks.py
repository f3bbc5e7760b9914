"""Check tasks and model lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_SCHEMA = (
    "task_id bigint, motype string, period string, start_day int, start_time int, "
    "indicators string, moentities string"
)


def read_tasks(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(TASK_SCHEMA).format(file_format).load(path)


def pending_tasks(tasks: DataFrame, ledger: DataFrame) -> DataFrame:
    """Tasks the ledger does not mention yet."""
    return tasks.join(ledger.select("task_id").distinct(), "task_id", "left_anti")


def read_models(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Model list ``motype`` from which task sheets are generated."""
    return spark.read.format(file_format).load(path).select(F.col("motype").cast("string"))
