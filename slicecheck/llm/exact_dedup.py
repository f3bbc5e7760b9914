"""Exact duplicates, combined in three steps so that no group of copies ends in one task.

1. Locally: rows with equal digest and equal text combine inside each map task.
2. By salt: what the tasks found is merged by (digest, salt, text), where the salt is
   the number of the map task, so that a group that every task has seen is spread.
3. Globally: the salt winners of a digest are combined by (digest, text).

The text is part of the grouping key in every step, so equal digests never stand for
equal texts on their own. Only a digest that was seen to have a single text is used to
give documents their group; the others are matched by digest and text.

Defined cases: a null text is the empty text. A null doc_id counts as smaller than any
other. Of rows that repeat the doc_id and the text of the row that stays, one stays.
Other columns are never looked at and may have any name. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicecheck.llm.common import text_of
from slicecheck.settings import written

SALTS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def normalised(df: DataFrame, text: str = "text") -> Column:
    """Lower-cased in A-Z only."""
    return F.translate(text_of(df, text), UPPER, LOWER)


def text_groups(docs: DataFrame, digest=sha256, salts: int = SALTS) -> DataFrame:
    """One row per group of equal texts: digest, keep_id, group_size, and the text itself
    (norm) where a digest has several texts, else null. ``docs``: id, norm."""
    keyed = docs.select("id", "norm", digest(F.col("norm")).alias("digest"))
    salted = (
        keyed.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "salt", "norm")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    # Dealt by the digest alone: the two groupings that follow need no further shuffle.
    groups = (
        salted.repartition("digest")
        .groupBy("digest", "norm")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )
    single = written(
        groups.groupBy("digest").agg(
            F.count("*").alias("texts"),
            F.max("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
        )
    )
    alone = single.where("texts = 1").select(
        "digest", F.lit(None).cast("string").alias("norm"), "keep_id", "group_size"
    )
    clashing = single.where("texts > 1").select("digest")
    if clashing.isEmpty():
        return alone
    shared = (
        keyed.join(clashing, "digest", "left_semi")
        .groupBy("digest", "norm")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    return alone.unionByName(written(shared))


def mark_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=sha256
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, sha (binary)."""
    rows = docs.select(docs[doc_id].alias("id"), normalised(docs, text).alias("norm"))
    groups = text_groups(rows, digest)
    keyed = rows.select(
        "id", "norm", digest(F.col("norm")).alias("digest"), sha256(F.col("norm")).alias("sha")
    )
    found = _with_group(keyed, groups).select("id", "keep_id", "group_size", "sha")
    # Rows that repeat the one that stays are counted, and one of them stays.
    stays = F.col("id").eqNullSafe(F.col("keep_id"))
    repeats = found.where(stays).groupBy(found.columns).agg(F.count("*").alias("n"))
    return (
        found.where(~stays)
        .withColumn("kept", F.lit(False))
        .unionByName(
            repeats.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).select(
                *found.columns, (F.col("i") == 1).alias("kept")
            )
        )
    )


def drop_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest=sha256
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = docs.select(docs[doc_id].alias("id"), normalised(docs, text).alias("norm"))
    groups = text_groups(rows, digest)
    # Joined by row, not by group: copies are spread over all tasks and drop out there.
    kept = groups.select(
        F.coalesce(F.col("keep_id").cast("string"), F.lit("")).alias("_of_id"),
        F.col("digest").alias("_of_digest"),
        F.col("norm").alias("_of_norm"),
    )
    norm = normalised(docs, text)
    keyed = docs.select(
        F.struct("*").alias("_row"),
        F.coalesce(docs[doc_id].cast("string"), F.lit("")).alias("_of_id"),
        digest(norm).alias("_of_digest"),
    )
    same = keyed.join(kept, ["_of_id", "_of_digest"])
    same = same.where(
        F.col("_of_norm").isNull()
        | (F.translate(F.coalesce(f"_row.{text}", F.lit("")), UPPER, LOWER) == F.col("_of_norm"))
    )
    one = Window.partitionBy("_of_id", "_of_digest", "_of_norm").orderBy("_of_id")
    return same.withColumn("_n", F.row_number().over(one)).where("_n = 1").select("_row.*")


def _with_group(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with their group; texts are joined on only where a digest has several."""
    found = keyed.drop("norm").join(groups.where("norm IS NULL").drop("norm"), "digest")
    shared = groups.where("norm IS NOT NULL")
    if shared.isEmpty():
        return found
    return found.unionByName(keyed.join(shared, ["digest", "norm"]).drop("norm"))


def query(docs: DataFrame) -> DataFrame:
    """op3: who stays, for every document."""
    return mark_copies(docs).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


SQL = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1
)
SELECT doc_id, keep_id, group_size,
       doc_id IS NOT DISTINCT FROM keep_id
         AND row_number() OVER (PARTITION BY doc_id, text_sha256) = 1 AS kept,
       text_sha256
FROM n JOIN g USING (text_sha256)
"""
