"""Pairwise quality ranking: held-out accuracy, folds, awkward rows."""
from __future__ import annotations

import collections
import zlib

import numpy as np

from tests.llm.conftest import prose
from tidewater.llm import ranking as R
from tidewater.llm.common import read

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    rows = R.document_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40
    right = sum(r.predicted == r.quality for r in rows)
    assert right >= 0.95 * len(rows)
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert sum(g > b for g in good for b in bad) >= 0.97 * len(good) * len(bad)


def test_training_never_sees_the_held_out_fold(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    ids = [r.doc_id for r in R.training_sample(docs, labels, 50).collect()]
    assert 0 < len(ids) <= 50 and all(zlib.crc32(str(i).encode()) % 5 for i in ids)


def test_rows_and_scores(spark, awkward, crowded, empty):
    labels = spark.createDataFrame([(7, 1, 0), (8, 1, 0), (9, 1, 0), (10, 0, 0), (13, 0, 0), (4, 0, 0), (4, 1, 0),
                                    (None, 1, 0), (12, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = R.document_scores(crowded, labels).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert R.document_scores(empty, labels).count() == 0


def test_without_both_labels(spark, awkward):
    labels = spark.createDataFrame([(7, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in R.document_scores(awkward, labels).collect()} == {0.3}


def _sample(spark, n_good=13, n_bad=5):
    rows = [(i, 1, (prose(i, 40 + i % 7) + ". ").capitalize() * 2) for i in range(n_good)]
    rows += [(100 + i, 0, prose(i, 30) + " ||| $$ " * (1 + i)) for i in range(n_bad)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id bigint, text string")
    known = spark.createDataFrame([(i, y) for i, y, _ in rows], "doc_id bigint, label int")
    return R.stored(R.featured(docs).join(known, "doc_id"), "ranking-test"), {i: (y, t) for i, y, t in rows}


def test_content_features_against_a_dictionary():
    for text in (None, "", " \n", "One", "a b a b A", prose(3, 500) + " ñé 😀", "x" * 100_000, prose(4, 50_000)):
        words = (text or "").encode().lower().split()
        counts = [0] * R.BUCKETS
        mask = (1 << 64) - 1
        grams = [(zlib.crc32(w) * 0xD6E8FEB86659FD93) & mask for w in words]
        grams += [(zlib.crc32(v) * 0x9E3779B97F4A7C15 + zlib.crc32(w) * 0xC2B2AE3D27D4EB4F) & mask
                  for v, w in zip(words, words[1:])]
        for g in grams:
            counts[(g >> 40) % R.BUCKETS] += 1
        size = sum(counts) ** 0.5
        want = [(c ** 0.5) / size if size else 0.0 for c in counts]
        assert np.allclose(R.content_features(text), want)
        assert len(R.features(text)) == len(R.FEATURES) + R.BUCKETS


def test_pairs_deal_rivals_evenly(spark):
    sample, truth = _sample(spark)
    pairs = R.preference_pairs(sample, 3, 5).collect()
    assert len({(p.winner, p.loser) for p in pairs}) == len(pairs) == 13 * 3
    assert all(truth[p.winner][0] == 1 and truth[p.loser][0] == 0 for p in pairs)
    met = collections.Counter(p.loser for p in pairs)
    assert max(met.values()) - min(met.values()) <= 1 and len(met) == 5
    for p in pairs:
        assert np.allclose(p.a, R.features(truth[p.winner][1])) and np.allclose(p.b, R.features(truth[p.loser][1]))


def test_weights_minimise_the_pairwise_loss(spark):
    """The gradient of mean log(1 + exp(-w(a - b))) + ridge |w|^2 / 2, summed pair by pair, is zero at the weights."""
    sample, _ = _sample(spark)
    ridge = 0.05
    w = np.array(R.fit(sample, per_document=3, ridge=ridge))

    def gradient(v):
        total = np.zeros_like(v)
        for p in pairs:
            d = np.array(p.a) - np.array(p.b)
            total -= d / (1 + np.exp(d @ v))
        return total / len(pairs) + ridge * v

    pairs = R.preference_pairs(sample, 3, 5).collect()
    assert np.linalg.norm(gradient(w)) < 0.01 * np.linalg.norm(gradient(np.zeros_like(w)))


def test_scores_and_quantile_cut(spark):
    _, truth = _sample(spark, 40, 15)
    docs = spark.createDataFrame([(i, t) for i, (_, t) in truth.items()], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, (y, _) in truth.items()], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in R.document_scores(docs, labels).collect()}
    sample = R.training_sample(docs, labels, 20_000).collect()
    w = np.array(R.fit(R.training_sample(docs, labels, 20_000)))
    cut = np.quantile([np.array(r.x) @ w for r in sample], np.mean([r.label == 0 for r in sample]))
    for i, (_, t) in truth.items():
        s = R.features(t) @ w
        assert abs(got[i].score - 1 / (1 + np.exp(-(s - cut)) * 0.7 / 0.3)) < 1e-6
        assert abs(s - cut) < 1e-9 or got[i].predicted == int(s >= cut)


def test_every_training_document_takes_part(spark, monkeypatch):
    """Several blocks and a label that is rarer than the blocks: each document is in a pair, and the weights are
    the optimum over all of them; a model of fewer documents has another gradient."""
    for n_good, n_bad in ((70, 23), (60, 3), (2, 41)):
        monkeypatch.setattr(R, "BLOCK", 8)
        monkeypatch.setattr(R, "BLOCKS", 2)
        sample, truth = _sample(spark, n_good, n_bad)
        pairs = R.preference_pairs(sample, 3, n_bad).collect()
        assert {p.winner for p in pairs} | {p.loser for p in pairs} == set(truth)
        w, ridge = np.array(R.fit(sample, per_document=3, ridge=0.05)), 0.05
        d = np.array([p.a for p in pairs]) - np.array([p.b for p in pairs])
        gradient = -(d / (1 + np.exp(d @ w))[:, None]).mean(axis=0) + ridge * w
        assert np.linalg.norm(gradient) < 1e-5 * np.linalg.norm(d.mean(axis=0) / 2)


def test_model_and_cut_read_all_labelled_rows(spark, monkeypatch):
    """20,011 further labelled rows: a fit or cut on the first 20,000 by hash would miss some."""
    seen = []
    monkeypatch.setattr(R, "fit", lambda sample, *a, **k: seen.append(sample.count()) or [1.0] + [0.0] * (
        len(R.FEATURES) + R.BUCKETS - 1))
    ids = spark.range(26_000).withColumnRenamed("id", "doc_id")
    docs = ids.selectExpr("doc_id", "repeat('a ', int(doc_id % 97)) as text")
    labels = ids.selectExpr("doc_id", "int(doc_id % 3 > 0) as quality")
    rows = R.document_scores(docs, labels).collect()
    kept = [i for i in range(26_000) if zlib.crc32(str(i).encode()) % 5]
    assert seen == [len(kept)] and len(kept) > 20_000
    cut = np.quantile([np.log1p(i % 97) for i in kept], np.mean([i % 3 == 0 for i in kept]))
    for r in rows[::501]:
        assert abs(r.score - 1 / (1 + np.exp(-(np.log1p(r.doc_id % 97) - cut)) * 0.7 / 0.3)) < 1e-9
