"""The registered operator queries, each over its whole intended table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import (credentials, decontam, mixing, ppm, prefix_trie, quality_rules, ranking, repair, sharding,
                           simhash, suffix_dedup, warc, wordpiece)
from tidewater.llm.common import read

#: A public byte-level vocabulary, read as word pieces: those with a leading space begin a word.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_classes(read(spark, sf_dir, "documents"), shingle=3, budget=2)


def op2_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.document_quality(read(spark, sf_dir, "documents"),
                                          read(spark, sf_dir, "labels"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read(spark, sf_dir, "documents"))


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(read(spark, sf_dir, "pages"), least_bytes=0)


def op5_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.document_cuts(read(spark, sf_dir, "documents"), length=100)


def op6_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.document_scores(read(spark, sf_dir, "documents"))


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(read(spark, sf_dir, "documents"), n_shards=40)


def op8_wordpiece_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    pieces = wordpiece.read_ranked_vocabulary(vocabulary)
    return wordpiece.token_counts(read(spark, sf_dir, "documents"), pieces)


def op9_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.document_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                                   cut_score=0.3)


def op10_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.document_secrets(read(spark, sf_dir, "documents"))


def op12_repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_conversations(read(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_classes, op2_quality_ratio, op3_mix_sources, op4_warc_index,
    op5_repeated_bytes, op6_ppm_scores, op7_feistel_shards, op8_wordpiece_counts, op9_pairwise_quality, op10_benchmark_overlaps,
    op11_linked_secrets, op12_repaired_conversations, op13_prefix_trie)}
