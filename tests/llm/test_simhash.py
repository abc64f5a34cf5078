"""SimHash classes against brute force, the trie join against all pairs."""
from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from tidewater.llm import simhash as S
from tidewater.llm.common import read


def brute_fp(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w)] if len(w) < k else [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(rows, budget=2):
    fps = [brute_fp(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[find(i)] = min(least.get(find(i), r.doc_id), r.doc_id)
    return sorted(((r.doc_id is None, r.doc_id or 0, f"{fps[i]:016x}", least.get(find(i))) for i, r in enumerate(rows)),
                  key=str)


@pytest.mark.parametrize("which", ["awkward", "table"])
def test_against_brute_force(request, spark, small_dir, which):
    docs = request.getfixturevalue("awkward") if which == "awkward" else read(spark, small_dir, "documents")
    got = S.document_classes(docs).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in got), key=str) == \
        brute_classes(docs.collect())


def cluster(rng, n):
    centre = rng.getrandbits(64)
    out = {centre}
    while len(out) < n:
        x = rng.choice(sorted(out))
        for b in rng.sample(range(64), rng.randint(1, 3)):
            x ^= 1 << b
        out.add(x)
    return out


@pytest.mark.parametrize("budget,node_rows", [(2, 4096), (2, 3), (0, 2), (1, 2), (3, 5)])
def test_links_against_all_pairs(spark, budget, node_rows):
    rng = random.Random(budget)
    values = sorted(cluster(rng, 60) | cluster(rng, 30) | {rng.getrandbits(64) for _ in range(60)} | {0, 1, 2**64 - 1})
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    got = {frozenset((r.x, r.y)) for r in S.links(
        spark.createDataFrame([(v,) for v in signed], "fp bigint"), budget, node_rows).collect()}
    want = {frozenset((signed[i], signed[j])) for i in range(len(values)) for j in range(i)
            if (values[i] ^ values[j]).bit_count() <= budget}
    assert got == want


def test_trie_pairs_of_many_groups():
    rng = random.Random(4)
    groups = [sorted(cluster(rng, n)) for n in (1, 2, 17, 40)]
    g = np.concatenate([[i] * len(x) for i, x in enumerate(groups)])
    v = np.array([x for xs in groups for x in xs], dtype=np.uint64)
    n = len(groups)
    got = S.trie_pairs(g, np.ones(len(v), bool), v, np.ones(n, np.int64), np.zeros(n, np.int64),
                       np.zeros(n, np.int64), 2)
    want = {(min(a, b), max(a, b)) for xs in groups for i, a in enumerate(xs) for b in xs[:i]
            if (a ^ b).bit_count() <= 2}
    assert {(min(int(v[i]), int(v[j])), max(int(v[i]), int(v[j]))) for i, j in got} == want


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 1001)], "x bigint, y bigint")
    got = {r.node: r.root for r in S.components(None, edges).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1001] == 1000


def test_deduplicated(crowded, empty):
    out = S.deduplicated(crowded)
    rows = out.collect()
    assert out.columns == crowded.columns
    classes = brute_classes(crowded.collect())
    ids = {c[3] for c in classes}
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(i for i in ids if i is not None)
    assert S.deduplicated(empty).count() == 0 and S.document_classes(empty).count() == 0
