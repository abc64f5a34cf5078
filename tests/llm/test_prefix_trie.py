"""The prefix trie against a dictionary of prefixes, also with every conversation in its own shard."""
from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidewater.llm import prefix_trie
from tidewater.llm.common import read

ROWS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows) -> dict[int, list]:
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def brute(sequences: dict[int, list]) -> dict[tuple, tuple]:
    members, nodes = defaultdict(list), {}
    for c, ts in sequences.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        below = [totals[q] for q in children[p]]
        totals[p] = (sum(x[0] for x in below) or 1, sum(x[1] for x in below) + (len(members[p]) - 1) * words)
    for p, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(sequences[c]) == len(p))
        nodes[p] = (min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children[p]), totals[p][0],
                    totals[p][1], hashlib.sha256(ends.encode()).hexdigest())
    return nodes


def got(df) -> list[tuple]:
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def want(rows) -> list[tuple]:
    return sorted(brute(rebuilt(rows)).values())


def awkward() -> list[tuple]:
    rng = random.Random(5)
    rows = []
    for c in range(-45, 130):                       # few distinct turns: many shared beginnings
        for t in range(rng.choice([0, 1, 1, 2, 3, 5])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "a b c.", "d"])))
    rows += [(200, None, None, None), (200, None, None, None), (201, 0, "user", None), (220, 0, "", " \t"), (221, 0, "user", "x"),
             (None, 0, "user", "lost"), (None, None, None, None)]
    for c in (300, 301, 302, 303, 304):              # beyond a block of columns
        rows += [(c, t, "user", f"w{t % 3} z" if t < 37 + c % 3 else f"own {c}") for t in range(45)]
    rows += [(c, t, "user", f"same {t}") for c in range(400, 460) for t in range(5)]
    rows += [(c, t, "user", "w " * 3000) for c in (520, 540) for t in range(2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 50])
def test_trie_equals_brute_force(spark, partitions):
    rows = awkward()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 as depth", "2 as key", "3 as edge", "4 as turns", "5 as shard")
        result = prefix_trie.conversation_trie(df)
        assert got(result) == want(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_trie_of_the_table_and_of_none(spark, small_dir):
    table = read(spark, small_dir, "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(prefix_trie.conversation_trie(table)) == want(rows)
    assert prefix_trie.conversation_trie(table.where("false")).collect() == []


def test_shard_sorts_deep_sequences_like_tuples():
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 60, 200)
    total = int(lengths.sum())
    a, b = rng.integers(0, 2, total), np.zeros(total, np.int64)
    a[rng.random(total) < 0.9] = 0
    shard = prefix_trie.Shard(np.arange(200)[::-1].copy(), lengths, a, b, np.ones(total, np.int64))
    paths = [tuple(shard.path(i)[::2]) for i in range(200)]
    assert paths == sorted(paths)
    for i in range(1, 200):
        common = 0
        while common < min(len(paths[i]), len(paths[i - 1])) and paths[i][common] == paths[i - 1][common]:
            common += 1
        assert shard.shared[i] == common
        if paths[i] == paths[i - 1]:
            assert shard.ids[i - 1] < shard.ids[i]
