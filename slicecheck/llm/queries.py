"""Every query of the subpackage, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from slicecheck.llm import (
    byte_bpe,
    collocations,
    dart_minhash,
    disclosure,
    exact_dedup,
    host_reputation,
    merge_rounds,
    packed_ids,
    rule_forest,
    source_mix,
    token_counts,
    toxic_terms,
    turn_repair,
)
from slicecheck.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
MERGES = public_tokenizers.path("byte_bpe_50k.json")


def op1_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.query(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_rule_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_forest.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.query(table(spark, sf_dir, "documents"))


def op4_toxic_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_terms.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.query(table(spark, sf_dir, "documents"))


def op6_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.query(table(spark, sf_dir, "documents"))


def op7_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_ids.digests(table(spark, sf_dir, "documents"), WORDS)


def op8_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.query(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.digests(docs, RANKS, PATTERN)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), WORDS)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.query(table(spark, sf_dir, "conversations"))


def op12_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_rounds.digests(table(spark, sf_dir, "documents"), MERGES)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.query(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_host_reputation,
        op2_rule_forest,
        op3_exact_dedup,
        op4_toxic_terms,
        op5_source_mix,
        op6_disclosure,
        op7_packed_ids,
        op8_dart_minhash,
        op9_byte_bpe,
        op10_token_counts,
        op11_turn_repair,
        op12_merge_rounds,
        op13_collocations,
    )
}
SQL = {
    "op1_host_reputation": host_reputation.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op5_source_mix": source_mix.SQL,
    "op13_collocations": collocations.SQL,
}
