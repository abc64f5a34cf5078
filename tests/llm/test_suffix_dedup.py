"""Repeated byte strings against brute force over all windows."""
from __future__ import annotations

import hashlib

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidewater.llm import suffix_dedup as S
from tidewater.llm.common import read


def brute(rows, length):
    """rows: (doc_id, text) in corpus order."""
    seen, out = set(), []
    for i, text in rows:
        b = (text or "").encode()
        mark = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if w in seen:
                mark[s:s + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for k, m in enumerate(mark) if m and (k == 0 or not mark[k - 1]))
        kept = bytes(x for x, m in zip(b, mark) if not m)
        out.append((i, len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [2000, 1])
@pytest.mark.parametrize("length", [100, 40])
def test_awkward_rows(awkward, hot, length):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    got = S.document_cuts(awkward.coalesce(1), length, hot)
    assert sorted(map(tuple, got.collect()), key=str) == brute([rows[k] for k in order], length)


@pytest.mark.parametrize("hot,parts", [(2000, 3), (2, 6)])
def test_table(spark, small_dir, hot, parts):
    docs = read(spark, small_dir, "documents").repartition(parts, "doc_id")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(map(tuple, S.document_cuts(docs, hot=hot).collect()), key=str) == brute(rows, 100)


def test_shared_passages_and_runs(spark):
    passage = prose(50, 60)
    texts = [(i, prose(100 + i, 20) + " " + passage + " " + prose(200 + i, 20)) for i in range(40)]
    texts += [(50, "ab" * 400), (51, "a" * 99), (52, "a" * 100), (53, "a" * 101), (54, passage[:120])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    for hot in (2000, 5):
        assert sorted(map(tuple, S.document_cuts(docs, hot=hot).collect()), key=str) == brute(texts, 100)


def test_windows_that_are_equal_share_a_phrase():
    a, b, c = prose(1, 30).encode(), prose(2, 50).encode(), prose(3, 40).encode()
    parsed = S.Parse([a + b + c, c + b + a], 100)
    phrase = {}
    flat = parsed.flat.tobytes()
    for first, last, h in zip(parsed.first, parsed.last, parsed.phrase):
        for s in range(first, last + 1):
            assert phrase.setdefault(flat[s:s + 100], h) == h
    assert np.all(parsed.first <= parsed.last)


def test_empty(empty):
    assert S.document_cuts(empty).count() == 0


def _stretches(seed: int, n: int, length: int):
    """Stretches around two triggers that share beginnings and ends, in corpus order per trigger."""
    rng = np.random.default_rng(seed)
    made = []
    for trigger in (b"T" * S.GRAM, b"U" * S.GRAM):
        for _ in range(n):
            left = bytes(rng.choice(list(b"ab"), rng.integers(0, length - S.GRAM + 1)).astype(np.uint8))
            right = bytes(rng.choice(list(b"ab"), rng.integers(0, 6)).astype(np.uint8)) + b"z" * length
            first = left[-3:]
            made.append((first + trigger + right[:length - S.GRAM], len(first)))
    return [m for m in made if len(m[0]) >= length]


def test_dictionary_suffix_array():
    phrases = list({b[:t + S.GRAM] for b, t in _stretches(1, 60, 40)})
    ranks = S.dictionary_suffixes(phrases)
    by_length = {}
    for i, x in enumerate(phrases):
        for k in range(ranks.shape[1]):
            assert (ranks[i, k] == -1) == (len(x) < S.GRAM + k)
            if len(x) >= S.GRAM + k:
                by_length.setdefault(k, []).append((x[-S.GRAM - k:], ranks[i, k]))
    seen = set()
    for pairs in by_length.values():                  # ranks order the suffixes of a length, by all their bytes
        def rightmost_last(x):
            return [*reversed(x[:-S.GRAM])][::-1], x[-S.GRAM:]
        order = sorted(set(pairs), key=lambda p: rightmost_last(p[0]))
        assert [r for _, r in order] == sorted({r for _, r in pairs}) and len(order) == len({s for s, _ in pairs})
        assert not seen & {r for _, r in pairs}
        seen |= {r for _, r in pairs}


def test_parse_suffix_array():
    rest = [b[t:] for b, t in _stretches(2, 80, 60)] + [b"T" * S.GRAM, b"T" * S.GRAM + b"\0"]
    rank, shared = S.parse_suffixes(rest)
    order = sorted(set(rest))
    assert [order[r] for r in rank] == rest
    for i in range(1, len(order)):
        common = next((k for k, (x, y) in enumerate(zip(order[i - 1], order[i])) if x != y),
                      min(len(order[i - 1]), len(order[i])))
        assert shared[i] == common


@pytest.mark.parametrize("seed,length", [(3, 40), (4, 36), (5, 100), (6, 31)])
def test_both_arrays_give_the_repeated_windows(seed, length):
    made = _stretches(seed, 300, length)
    owner, inside = S.repeated_windows([m[0] for m in made], [m[1] for m in made], length)
    seen, want = set(), []
    for i, (body, _) in enumerate(made):
        for s in range(min(len(body) - length, made[i][1]) + 1):
            if body[s:s + length] in seen:
                want.append((i, s))
            seen.add(body[s:s + length])
    got = [(i, s) for i, s in zip(owner.tolist(), inside.tolist())]
    assert got == want and want


def test_equal_hashes_are_verified():
    flat = np.frombuffer(b"abcabdabc", dtype=np.uint8)
    assert S.equal_strings(flat, np.array([0, 0]), np.array([3, 6]), 3).tolist() == [False, True]


def test_extra_columns_with_clashing_names(awkward, crowded):
    plain, full = (sorted(map(tuple, S.document_cuts(x.coalesce(1)).collect()), key=str) for x in (awkward, crowded))
    assert plain == full


def test_texts_on_bytes_and_very_long_texts(spark):
    long = prose(9, 60_000)
    texts = [(1, long), (2, long[1000:200_000]), (3, long[::-1]), (4, "é" * 300 + long[5:300])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert sorted(map(tuple, S.document_cuts(docs).collect()), key=str) == brute(texts, 100)
