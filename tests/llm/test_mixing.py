"""Mixing: targets, packed blocks and what is taken, against plain Python."""
from __future__ import annotations

import math
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from tidewater.llm import mixing
from tidewater.llm.common import read


def targets(sizes: dict, share=1.5, most=2.0) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    out, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        free -= over
    return out


def words(text) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(docs, **how):
    got, block = mixing.mix_documents(docs, **how).collect(), how.get("block_words", 256)
    source = docs.select("doc_id", "source", "text").collect()
    assert len(got) == len(source)
    sizes = {}
    for r in source:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    want = targets(sizes)
    assert sorted((r.source_size, round(r.target, 6)) for r in got) == sorted(
        (sizes[r.source], round(want[r.source], 6)) for r in source)
    taken = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        key = (r.source_size, round(r.target, 6))
        taken[key] = taken.get(key, 0) + r.taken
    n = {}
    for s in sizes:
        key = (sizes[s], round(want[s], 6))
        n[key] = n.get(key, 0) + 1
    for key, t in taken.items():
        assert abs(t - n[key] * key[1]) <= n[key] * (block + 1)
    return got


def test_against_python(spark, small_dir):
    check(read(spark, small_dir, "documents"), block_words=64)


def test_awkward_rows_and_reruns(awkward, crowded):
    one = check(awkward, block_words=8)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    two = mixing.mix_documents(crowded.repartition(5), block_words=8).collect()
    assert sorted(map(key, one)) == sorted(map(key, two))


def test_shard_draws_add_up_to_the_quotas(awkward):
    rows = awkward.select("source", mixing.word_count(F.col("text")).alias("size"),
                          F.xxhash64("doc_id", "text").alias("key"))
    _, src, slots = mixing.plan(rows, 16, 32, 11, 8, 1.5, 2.0)
    quota = {r.pos: r.slots for r in src.collect()}
    drawn = {r.pos: r.n for r in mixing.shard_counts(slots).groupBy("pos").agg(F.sum("n_blocks").alias("n")).collect()}
    assert drawn == {p: n for p, n in quota.items() if n}
    assert slots.select("shard", "place").distinct().count() == slots.count() == sum(quota.values())
    assert slots.groupBy("pos", "turn", "block").count().where("count > 1").count() == 0


def test_mixed_rows_repeat_whole_documents(crowded, empty):
    out = mixing.mixed_rows(crowded, block_words=8)
    assert out.columns == crowded.columns
    n = {(r.doc_id, r.text): r["count"] for r in out.groupBy("doc_id", "text").count().collect()}
    have = {(r.doc_id, r.text): r["count"] for r in crowded.groupBy("doc_id", "text").count().collect()}
    assert set(n) <= set(have) and all(c <= 2 * have[k] for k, c in n.items())
    assert mixing.mixed_rows(empty).count() == mixing.mix_documents(empty).count() == 0


def test_no_words_at_all(spark, awkward):
    got = mixing.mix_documents(awkward.where("doc_id in (0, 1, 2)")).collect()
    assert [(r["size"], r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 3


def test_blocks_hold_every_source_s_words(awkward):
    how = dict(block_words=16, blocks_per_shard=32)
    out = mixing.mixed_blocks(awkward, share=10.0, most=1.0, **how).collect()      # each source once
    want, got = {}, {}
    for r in awkward.collect():
        want.setdefault(r.source, []).extend(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    for r in out:
        assert 0 < len(r.words) <= 16 and 0 <= r.place < 32
        got.setdefault(r.source, []).extend(r.words)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items() if v}
    at = [r.shard * 32 + r.place for r in out]
    assert sorted(at) == list(range(len(at)))
    size = sum(r.taken for r in mixing.mix_documents(awkward, **how).collect())
    assert sum(len(r.words) for r in mixing.mixed_blocks(awkward, **how).collect()) == size


# ---- the whole mix once more, in plain Python ------------------------------

def xx(*values) -> int:
    """Spark's xxhash64 of (value, format) pairs: 'q' a long, 'i' an int, 's' a string; nulls are passed over."""
    h = 42
    for v, kind in values:
        if v is not None:
            raw = v.encode() if kind == "s" else struct.pack("<" + kind, v)
            h = xxhash.xxh64(raw, seed=h % 2 ** 64).intdigest()
    return h - 2 ** 64 if h >= 2 ** 63 else h


def permuted(x: int, n: int, key) -> int:
    a = max(math.ceil(math.sqrt(n)), 1)
    b = max(-(-n // a), 1)
    while True:
        left, right = divmod(x, b)
        for i in range(4):
            left = (left + xx((right, "q"), (i, "i"), key) % a) % a
            right = (right + xx((left, "q"), (i + 100, "i"), key) % b) % b
        x = left * b + right
        if x < n:
            return x


def mixed(docs, block, per_shard, lanes, seed=11, share=1.5, most=2.0):
    """({(shard, place): (source, words)}, sorted (doc_id, size, taken)) by the rules of the module."""
    rows, sizes = [], {}
    for r in docs:
        found = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        key = xx((r.doc_id, "q"), (r.text, "s"))
        rows.append((r.source, xx((key, "q"), (len(found), "q")) % lanes, key, len(found), r.doc_id, found))
        sizes[r.source] = sizes.get(r.source, 0) + len(found)
    want = targets(sizes, share, most)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    slots, streams = [], {}
    for pos, name in enumerate(names):
        stream = streams[pos] = []                       # (word, row number) of the source in order
        for i, row in sorted(((i, r) for i, r in enumerate(rows) if r[0] == name), key=lambda x: x[1][1:4]):
            stream += [(w, i) for w in row[5]]
        size, n = sizes[name], -(-sizes[name] // block)
        passes = int(want[name] // size) if size else 0
        rest = math.floor(want[name] - passes * size + 0.5)
        count = passes * n + -(-rest // block)
        for k in range(count):
            index = permuted(k % n, n, (xx((pos, "q"), (k // n, "q"), (seed, "i")), "q"))
            limit = rest % block if k == count - 1 and rest % block else block
            slots.append((pos, stream[index * block:(index + 1) * block][:limit]))
    blocks, taken = {}, [0] * len(rows)
    for at, (pos, cut) in enumerate(slots):
        place = permuted(at, len(slots), (seed, "q"))
        blocks[divmod(place, per_shard)] = (names[pos], [w for w, _ in cut])
        for _, i in cut:
            taken[i] += 1
    key = lambda t: tuple((x is None, x or 0) for x in t)
    return blocks, sorted(((r[4], r[3], t) for r, t in zip(rows, taken)), key=key)


@pytest.mark.parametrize("block, per_shard, lanes", [(8, 32, 8), (64, 16, 1024), (256, 4096, 1024)])
def test_every_slot_and_word_against_python(awkward, block, per_shard, lanes):
    docs = awkward.select("doc_id", "source", "text")
    blocks, taken = mixed(docs.collect(), block, per_shard, lanes)
    how = dict(block_words=block, blocks_per_shard=per_shard, lanes=lanes)
    got = {(r.shard, r.place): (r.source, r.words) for r in mixing.mixed_blocks(docs, **how).collect()}
    assert got == blocks
    key = lambda t: tuple((x is None, x or 0) for x in t)
    rows = mixing.mix_documents(docs, **how).select("doc_id", "size", "taken").collect()
    assert sorted(map(tuple, rows), key=key) == taken


def test_a_source_below_a_block_meets_its_target(spark):
    text = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    docs = spark.createDataFrame([(1, "a", text(200, "x")), (2, "b", text(5000, "y")), (3, "c", text(500, "z"))],
                                 "doc_id long, source string, text string")
    for share in (0.3, 0.8, 1.5):
        for r in mixing.mix_documents(docs, share=share).collect():
            assert abs(r.taken - r.target) <= (1 if r["size"] <= 256 else 256)


def test_lanes_follow_the_rows():
    assert mixing.lane_count(0) == mixing.lane_count(1_000_000) == 1024
    assert mixing.lane_count(10 ** 10) == -(-10 ** 10 // 4096)
