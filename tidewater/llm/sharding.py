"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

``shard_rows`` ranks all rows, permutes the ranks with a keyed Feistel network
(cycle walking down to the number of rows) and reads shard and slot off the
permuted number: shard = p mod shards, slot = p div shards.  Shards differ by
at most one row and slots have no gaps.  ``locate`` computes the place of one
row number without any table, so a reader can find a row again.

Defined results: equal rows get different, interchangeable places; a null or
empty text has size ``overhead`` and CRC 0; an empty table gives no rows;
extra columns are carried along, but ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import feistel, numbered, packed


def locate(row: Column, total: Column, n_shards: int, seed: int) -> Column:
    """struct(shard, slot) of a global row number."""
    p = feistel(row, total, F.lit(seed).cast("long"))
    return F.transform(F.array(p), lambda v: F.struct(
        F.pmod(v, F.lit(n_shards)).cast("int").alias("shard"),
        ((v - F.pmod(v, F.lit(n_shards))) / n_shards).cast("long").alias("slot")))[0]


def shard_rows(df: DataFrame, order: list[Column], n_shards: int, seed: int = 7,
               name: str = "shards") -> DataFrame:
    """``df`` with ``shard`` (0..n_shards-1) and ``slot``; ``order`` fixes the row numbers."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    df = df.drop("shard", "slot")
    keys = {f"_order{i}": c for i, c in enumerate(order)}
    rows, total = numbered(packed(df, **keys), [F.col(k) for k in keys], name)
    at = locate(F.col("_rank"), F.lit(total).cast("long"), n_shards, seed)
    return rows.withColumn("_place", at).select("_row.*", "_place.shard", "_place.slot")


def document_shards(docs: DataFrame, n_shards: int = 40, seed: int = 7,
                    overhead: int = 16) -> DataFrame:
    """Place of every document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text) + overhead).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return shard_rows(slim, order, n_shards, seed, "document-shards").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
