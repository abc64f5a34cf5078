"""Feistel sharding: a bijection, near-equal shards, the same places whatever the layout."""
from __future__ import annotations

import math
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from tidewater.llm import sharding
from tidewater.llm.common import feistel, numbered


def spark_hash(*longs) -> int:
    h = 42
    for size, x in longs:
        h = xxhash.xxh64_intdigest(struct.pack("<q" if size == 8 else "<i", x), h) if size == 8 else _int_hash(x, h)
    return h - (1 << 64) if h >= 1 << 63 else h


def _int_hash(x: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(struct.pack("<i", x), seed)


def brute_feistel(x: int, n: int, key: int) -> int:
    a = max(1, math.ceil(math.sqrt(n)))
    b = max(1, math.ceil(n / a))
    while True:
        left, right = x // b, x % b
        for i in range(4):
            left = (left + spark_hash((8, right), (4, i), (8, key)) % a) % a
            right = (right + spark_hash((8, left), (4, i + 100), (8, key)) % b) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 1000])
def test_feistel_is_a_bijection_and_matches_brute_force(spark, n):
    got = {r.id: r.p for r in spark.range(n).select(
        "id", feistel(F.col("id"), F.lit(n).cast("long"), F.lit(7).cast("long")).alias("p")).collect()}
    assert sorted(got.values()) == list(range(n))
    assert all(got[i] == brute_feistel(i, n, 7) for i in range(0, n, max(1, n // 60)))


def test_document_shards(awkward):
    got = sharding.document_shards(awkward, n_shards=6).collect()
    assert len(got) == awkward.count()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(s, [])) for s in range(6)]
    assert max(sizes) - min(sizes) <= 1
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()) + 16,
                   zlib.crc32((r.text or "").encode())) for r in awkward.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in got) == want
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_places_do_not_depend_on_the_layout(awkward):
    one = sharding.document_shards(awkward.repartition(1)).collect()
    many = sharding.document_shards(awkward.repartition(7)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in (r.doc_id, r["size"], r.text_crc32, r.shard, r.slot))
    assert sorted(map(key, one)) == sorted(map(key, many))


def test_equal_rows_are_spread_over_ranges(spark):
    rows, total = numbered(spark.range(4000).select(F.lit(1).alias("k")), [F.col("k")], "t")
    assert total == 4000 and rows.select("_rank").distinct().count() == 4000


def test_extra_columns_and_empty(crowded, empty):
    out = sharding.shard_rows(crowded, [F.col("doc_id")], 3)
    assert set(out.columns) == set(crowded.columns) and len(out.columns) == len(crowded.columns)
    assert out.where("key <> 'key'").count() == 0 and out.where("shard not between 0 and 2").count() == 0
    assert sharding.document_shards(empty).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_rows(empty, [F.col("doc_id")], 0)
