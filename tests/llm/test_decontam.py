"""Spaced-seed decontamination: changed passages, blocks of seeds, against brute force."""
from __future__ import annotations

import itertools
import time

import pytest
import regex
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidewater.llm import decontam as D
from tidewater.llm.common import read

ITEMS = "item_id bigint, text string, extra string"


def tokens(text):
    return regex.findall(r"[\p{L}\p{M}\p{N}]+", (text or "").lower())


def overlaps(doc, item, window=13, least=0.8) -> bool:
    w = min(window, len(item))
    if not w:
        return False
    for diag in range(-len(item), len(doc)):
        lo, hi = max(0, -diag), min(len(item), len(doc) - diag)
        eq = [item[k] == doc[k + diag] for k in range(lo, hi)]
        if any(sum(eq[s:s + w]) >= least * w for s in range(len(eq) - w + 1)):
            return True
    return False


@pytest.fixture(scope="module")
def planted(spark):
    item = prose(30, 40)
    words = item.split()
    for i in (3, 9, 17, 25, 33):
        words[i] = "other"
    texts = [(1, prose(31, 90) + " " + item + " " + prose(32, 20)), (2, prose(33, 50) + " " + " ".join(words)),
             (3, prose(34, 100)), (4, None), (5, ""), (6, item.upper().replace(" ", ", ")),
             (7, " ".join(item.split()[:8]) + " " + prose(35, 40)), (8, "only two"), (None, item), (1, item),
             (9, prose(36, 30) + " only two three four five " + prose(37, 30))]
    benchmark = [(0, item, "x"), (1, "only two three four five", "x"), (2, None, None), (3, "", "x"),
                 (4, "only two", "x"), (None, prose(38, 30), "x"), (0, item, "y")]
    return (spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(benchmark, ITEMS))


def pairs(df):
    return sorted(((r.doc_id, r.item_id) for r in df.collect()), key=str)


def test_against_brute_force(planted):
    docs, benchmark = planted
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in benchmark.collect()
            if overlaps(tokens(d.text), tokens(b.text))}
    assert pairs(D.matches(docs, benchmark)) == sorted(want, key=str)


def test_small_blocks_and_segments_change_nothing(planted, monkeypatch):
    docs, benchmark = planted
    want = pairs(D.matches(docs, benchmark))
    assert pairs(D.matches(docs, benchmark, block_seeds=200)) == want
    monkeypatch.setattr(D, "SEGMENT", 10)
    assert pairs(D.matches(docs, benchmark)) == want


def test_table_against_brute_force(spark, small_dir):
    docs, benchmark = read(spark, small_dir, "documents"), read(spark, small_dir, "benchmark")
    got = set(pairs(D.matches(docs, benchmark)))
    items = [(b.item_id, tokens(b.text)) for b in benchmark.collect()]
    grams = {}
    for i, t in items:
        for k in range(len(t) - 4):
            grams.setdefault(tuple(t[k:k + 5]), set()).add(i)
    want = set()
    for d in docs.collect():
        doc = tokens(d.text)
        near = {i for k in range(len(doc) - 4) for i in grams.get(tuple(doc[k:k + 5]), ())}
        want |= {(d.doc_id, i) for i in near if overlaps(doc, dict(items)[i])}
    assert got == want and want


def test_decontaminated(planted, crowded, empty, spark):
    docs, benchmark = planted
    left = sorted(str(r.doc_id) for r in D.decontaminated(docs, benchmark).collect())
    assert left == ["3", "4", "5", "7"]
    own = spark.createDataFrame([(1, prose(2, 120), "x")], ITEMS)
    out = D.decontaminated(crowded, own)
    assert out.columns == crowded.columns and out.where(F.col("text") == prose(2, 120)).count() == 0
    assert D.decontaminated(empty, benchmark).count() == 0
    assert D.matches(docs, benchmark.where("false")).count() == 0


def test_masks_lose_no_allowed_change():
    """Every way to change a fifth of a window's words leaves some seed of its family unchanged."""
    for n in range(1, 14):
        masks = next(m for words, m in D.FAMILIES if n >= words)
        kept = [{o + i for i, c in enumerate(m) if c == "1"} for m in masks for o in range(n - len(m) + 1)]
        changes = int(n - 0.8 * n + 1e-9)
        for changed in itertools.combinations(range(n), changes):
            assert any(not seed & set(changed) for seed in kept), (n, changed)


def test_changed_short_items_are_all_found(spark):
    """Items of 12 and 13 words with every pattern of two changes, alone in a long text."""
    benchmark, docs = [], []
    for n in (12, 13):
        item = [f"w{n}x{i}" for i in range(n)]
        benchmark.append((n, " ".join(item), "x"))
        for k, changed in enumerate(itertools.combinations(range(n), 2)):
            words = ["z" if i in changed else w for i, w in enumerate(item)]
            docs.append((1000 * n + k, " ".join(["fill"] * (900 + k) + words + ["end"] * 200)))
    found = pairs(D.matches(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(benchmark, ITEMS)))
    assert found == sorted(((i, i // 1000) for i, _ in docs), key=str)


def test_document_segments_change_nothing(planted, monkeypatch):
    docs, benchmark = planted
    whole = sorted((tuple(r) for r in D.matches(docs, benchmark).collect()), key=str)
    monkeypatch.setattr(D, "DOC_SEGMENT", 5)
    assert sorted((tuple(r) for r in D.matches(docs, benchmark).collect()), key=str) == whole


def test_time_is_linear_in_the_text(spark):
    benchmark = spark.createDataFrame([(0, prose(50, 30), "x")], ITEMS)

    def seconds(n):
        docs = spark.createDataFrame([(1, prose(51, n))], "doc_id bigint, text string")
        best = 1e9
        for _ in range(2):
            began = time.time()
            D.matches(docs, benchmark).collect()
            best = min(best, time.time() - began)
        return best

    start = seconds(10)
    short, long = seconds(80_000) - start, seconds(160_000) - start
    assert long < 2.2 * max(short, 0.0) + 1.5
