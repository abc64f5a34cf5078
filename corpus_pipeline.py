"""Corpus preparation in five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's rows as Parquet to the cluster's shared folder and reads them
back as the next one's input.  All stages but the last return the columns of
``documents``; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm import decontam, mixing, quality_rules, sharding, simhash
from tidewater.llm.common import read, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio test."""
    return quality_rules.kept_rows(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each SimHash class."""
    return simhash.deduplicated(docs, shingle=3, budget=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontam.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source near its target; a document comes up to two times."""
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard (0 to 39) and slot."""
    order = [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")), F.col("source"),
             F.col("lang")]
    return sharding.shard_rows(docs, order, n_shards=40)


STAGES = [("quality rules", quality), ("near duplicates", near_dedup),
          ("benchmark decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]

#: The hashes and permutations of these stages have no SQL form in DuckDB.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{i + 1}")
    return docs
