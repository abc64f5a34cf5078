"""Longest-match token counts against greedy matching piece by piece."""
from __future__ import annotations

import os

import pytest
from hypothesis import given, settings, strategies as st

from tidewater.llm import wordpiece as T
from tidewater.llm.common import read

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def greedy(word, start, inner):
    i = n = 0
    while i < len(word):
        pieces = start if i == 0 else inner
        j = next((j for j in range(len(word), i, -1) if word[i:j] in pieces), None)
        if j is None:
            return -1
        i, n = j, n + 1
    return n


pieces = st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=12)


@settings(max_examples=300, deadline=None)
@given(pieces, pieces, st.lists(st.binary(min_size=1, max_size=14).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=8))
def test_automaton_is_greedy(start, inner, words):
    match = T.LongestMatch(start, inner)
    assert [match.count(w) for w in words] == [greedy(w, start, inner) for w in words]


def check(docs, vocabulary):
    start, inner = map(set, T.split_vocabulary(vocabulary))
    want = []
    for r in docs.collect():
        raw = (r.text or "").encode()
        n = [greedy(b" " + w, start, inner) for w in raw.split()]
        cost = [max(x, 1) if x >= 0 else 1 for x in n]
        want.append((r.doc_id, len(raw), len(n), sum(cost), n.count(-1), max(cost, default=0)))
    got = [tuple(r) for r in T.token_counts(docs, vocabulary).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_small_vocabulary_with_unknown_words(awkward, empty):
    vocabulary = [b" a", b" ab", b"b", b"c", b"abc", b" The", b" ", b"d"]
    check(awkward, vocabulary)
    assert T.token_counts(empty, vocabulary).count() == 0


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")
def test_public_vocabulary_covers_every_word(spark, awkward, small_dir):
    vocabulary = T.read_ranked_vocabulary(VOCABULARY)
    docs = read(spark, small_dir, "documents").limit(60)
    check(docs.unionByName(awkward.where("doc_id not in (5, 6, 13)")), vocabulary)
    assert T.token_counts(docs, vocabulary).where("n_unknown > 0").count() == 0


def test_words_beyond_the_cache(awkward, monkeypatch):
    monkeypatch.setattr(T, "CACHE_WORDS", 2)
    check(awkward, [b" a", b"b", b" ", b"c"])
