"""Quality rules: base columns and likelihood ratio against plain Python."""
from __future__ import annotations

import math
import re
import struct

import pytest
import xxhash

from tidewater.llm import quality_rules as Q
from tidewater.llm.common import read


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else \
        {g for g, n in __import__("collections").Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in many for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n, rep = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), rep,
            n < 50 or 100 * rep > 50 * n)


def _hash(*parts) -> int:
    h = 42
    for x in parts:
        h = xxhash.xxh64_intdigest(x if isinstance(x, bytes) else struct.pack("<q", x), h)
    return h - (1 << 64) if h >= 1 << 63 else h


def buckets(text, k):
    h = [_hash(w.encode()) for w in words(text)]
    return [x % k for x in h] + [_hash(x, y) % k for x, y in zip(h, h[1:])]


@pytest.mark.parametrize("which", ["awkward", "table"])
def test_against_python(request, spark, small_dir, which):
    docs = request.getfixturevalue("awkward") if which == "awkward" else read(spark, small_dir, "documents")
    labels = (spark.createDataFrame([(9, 1, 0), (5, 1, 0), (7, 0, 0), (None, 1, 0), (12, None, 0)],
                                    "doc_id bigint, quality int, toxic int")
              if which == "awkward" else read(spark, small_dir, "labels"))
    k = 256
    got = Q.document_quality(docs, labels, buckets=k).collect()
    rows = docs.select("doc_id", "text").collect()
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and r.doc_id is not None}
    raw, trusted = [1] * k, [1] * k
    for r in rows:
        for b in buckets(r.text, k):
            raw[b] += 1
            trusted[b] += r.doc_id in good
    model = [math.log(y / sum(trusted)) - math.log(x / sum(raw)) for x, y in zip(raw, trusted)]
    want = []
    for r in rows:
        b = buckets(r.text, k)
        ratio = sum(model[x] for x in b) / len(b) if b else None
        want.append((r.doc_id, *base(r.text), ratio))
    order = lambda x: tuple((v is None, v if v is not None else 0) for v in x[:6])
    have = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
                    r.ratio, r.kept) for r in got), key=order)
    for h, w in zip(have, sorted(want, key=order), strict=True):
        assert h[:7] == w[:7]
        assert h[7] == pytest.approx(w[7], abs=1e-9) if w[7] is not None else h[7] is None
        assert h[8] == (not w[6] and w[7] is not None and w[7] >= Q.THRESHOLD)


def test_kept_rows(spark, crowded, empty):
    labels = spark.createDataFrame([(9, 1, 0)], "doc_id bigint, quality int, toxic int")
    out = Q.kept_rows(crowded, labels, threshold=-100.0)
    assert out.columns == crowded.columns and out.where("kept <> 'kept'").count() == 0
    assert out.count() == sum(not base(r.text)[-1] for r in crowded.collect())
    assert Q.kept_rows(empty, labels).count() == 0


def test_no_trusted_texts_leave_the_base_rules(spark, awkward):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = Q.document_quality(awkward, labels).collect()
    assert all(r.kept == (not r.base_failed) for r in got)


def test_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.document_quality(read(spark, sf, "documents"), read(spark, sf, "labels")).join(
        read(spark, sf, "labels"), "doc_id").where("not base_failed").collect()
    clean = [r.kept for r in got if r.quality == 1]
    junk = [not r.kept for r in got if r.quality == 0]
    assert sum(clean) == len(clean) and sum(junk) >= 0.9 * len(junk)


def test_every_text_labelled_1_is_trusted(spark):
    labels = spark.range(25_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert Q.trusted_ids(labels.union(labels)).count() == 25_000
