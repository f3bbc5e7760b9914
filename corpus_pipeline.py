"""From raw documents to token ids: five stages, each written and read again by the next.

Stages 1 to 4 return the columns of ``documents``; the last returns the ids of the text,
and whether their bytes are those of the text again. Every stage works on all that the
stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slicecheck.llm import byte_bpe, dart_minhash, exact_dedup, source_mix, toxic_terms
from slicecheck.llm.common import stored, table
from slicecheck.llm.queries import PATTERN, RANKS
from slicecheck.settings import passing_tables


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a model learned from the labelled ones."""
    return toxic_terms.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased) the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return dart_minhash.drop_near_copies(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times."""
    return source_mix.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip: the bytes of the ids are the text's."""
    return byte_bpe.encode_checked(docs, RANKS, PATTERN)


STAGES = [
    ("without_toxic", without_toxic),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixed_sources", mixed_sources),
    ("token_ids", token_ids),
]

# Learned scores, components and merges are beyond SQL; tests/llm/test_pipeline.py holds
# the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def save(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Writes the rows of ``run`` to ``path`` and removes what the stages left in the checkpoint
    folder, copies of the corpus among them. ``run`` alone leaves them, as its rows are read later."""
    with passing_tables(spark):
        run(spark, sf_dir).write.parquet(path)
