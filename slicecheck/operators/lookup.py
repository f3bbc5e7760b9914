"""Key/value metadata as tables.

Hashes are rows ``(key, field, value)`` and texts are rows ``(key, value)``.
Results stay in row form as well: a hash of any size is many small rows, never
one map built inside a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicecheck.functions.text import indicator_column, same_text, split_list

# The keys under which the metadata lies.
MODEL_NAMES = "ALLMODELMAPPING"
MODEL_SEQUENCES = "MOTYPE:MOTYPEID:SEQUENCE"
INDICATOR_SEQUENCES = "ALLINDICATORID2SEQ:CONF"
OBJECT_LISTS = "MOTYPE:OBJ:LIST:"
MODEL_COLUMNS = "MOTYPE:CONFIG:"
OBJECT = "OBJ:"
OBJECT_KEY_FIELD = "MO"
NO_KEY = "null"


def hash_entries(hashes: DataFrame, key: str) -> DataFrame:
    """All entries ``(field, value)`` of one hash."""
    return hashes.where(F.col("key") == key).select("field", "value")


def model_names(hashes: DataFrame) -> DataFrame:
    """Model id to name."""
    return hash_entries(hashes, MODEL_NAMES).select(
        F.col("field").alias("motype"), F.col("value").alias("model_name")
    )


def with_model_name(df: DataFrame, hashes: DataFrame) -> DataFrame:
    """Adds ``model_name``, null for models without one."""
    return df.join(model_names(hashes), "motype", "left")


def indicator_columns(hashes: DataFrame) -> DataFrame:
    """Indicator id to the name of its column. Upper case: tables may differ in case."""
    return hash_entries(hashes, INDICATOR_SEQUENCES).select(
        F.col("field").alias("indicator_id"), indicator_column(F.col("value")).alias("column_name")
    )


def model_columns(models: DataFrame, texts: DataFrame) -> DataFrame:
    """The columns configured for each model, one row per column with its position;
    a model without a configuration keeps one row with nulls.
    """
    config = texts.select(F.col("key").alias("_key"), split_list(F.col("value")).alias("_columns"))
    key = F.concat(F.lit(MODEL_COLUMNS), F.col("motype"))
    return models.join(config, key == F.col("_key"), "left").select(
        *models.columns, F.posexplode_outer("_columns").alias("pos", "column_name")
    )


def object_ids(models: DataFrame, texts: DataFrame) -> DataFrame:
    """``motype, object_id, list_no, item_no``: the ids reached from a model through
    its list of lists. A list that does not exist drops out alone.
    """
    lists = texts.select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    key = F.concat(F.lit(OBJECT_LISTS), F.col("motype"))
    list_keys = models.join(lists, key == F.col("_key")).select(
        "motype", F.posexplode(split_list(F.col("_value"))).alias("list_no", "list_key")
    )
    return list_keys.join(lists, F.col("list_key") == F.col("_key")).select(
        "motype", "list_no", F.posexplode(split_list(F.col("_value"))).alias("item_no", "object_id")
    )


def model_objects(models: DataFrame, hashes: DataFrame, texts: DataFrame) -> DataFrame:
    """``motype, mo, field, value``: the records of each model's objects by entity.
    Records without an entity key are left out; of several records of one entity
    the last in list order stays.
    """
    sequences = hash_entries(hashes, MODEL_SEQUENCES).select(
        F.col("field").alias("motype"), F.col("value").alias("sequence")
    )
    # An id may be listed very often: only its last place counts.
    position = F.shiftleft(F.col("list_no").cast("bigint"), 32) + F.col("item_no")
    ids = object_ids(models, texts).groupBy("motype", "object_id").agg(F.max(position).alias("position"))
    key = F.concat(F.lit(OBJECT), "sequence", F.lit(":"), "object_id")
    keyed = ids.join(sequences, "motype").select("motype", key.alias("key"), "position")
    entities = hashes.where(
        (F.col("field") == OBJECT_KEY_FIELD)
        & F.col("value").isNotNull()
        & ~same_text(F.col("value"), NO_KEY)
    ).select("key", F.col("value").alias("mo"))
    last = (
        keyed.join(entities, "key").groupBy("motype", "mo").agg(F.max_by("key", "position").alias("key"))
    )
    return last.join(hashes, "key").select("motype", "mo", "field", "value")
