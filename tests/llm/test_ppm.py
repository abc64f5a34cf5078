"""PPM scores against a slow model, the base score against plain counts."""
from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewater.llm import ppm as P
from tidewater.llm.common import read


class Slow:
    """PPM method C with exclusion, symbol by symbol."""

    def __init__(self, texts, order):
        self.order, self.count = order, [defaultdict(Counter) for _ in range(order + 1)]
        for t in texts:
            b = bytes(order) + t + b"\xff"
            for i in range(order, len(b)):
                for k in range(order + 1):
                    self.count[k][b[i - k:i]][b[i]] += 1

    def log10(self, text):
        b, total = bytes(self.order) + text + b"\xff", 0.0
        for i in range(self.order, len(b)):
            out, p = set(), 1.0
            for k in range(self.order, -1, -1):
                seen = self.count[k].get(b[i - k:i])
                if not seen:
                    continue
                left = {s: n for s, n in seen.items() if s not in out}
                escape = len(left) if len(seen) < 256 else 0
                whole = sum(left.values()) + escape
                if b[i] in left:
                    p *= left[b[i]] / whole
                    break
                if whole:
                    p *= escape / whole
                out |= set(left)
            else:
                p *= 1 / (256 - len(out))
            total += math.log10(p)
        return total


TRAIN = [b"abracadabra", b"", b"abra abra", "ñandú né".encode(), b"\x00\x00zz", b"aaaaaaaaab"]
TEST = [b"", b"abrac", b"zebra", "ñ".encode(), b"a" * 20, bytes(range(1, 200))]


@pytest.mark.parametrize("order", [0, 1, 3, 5])
def test_model_matches_the_slow_one(order):
    keys, n = P.gram_counts(TRAIN, order)
    model, slow = P.Model(P.lower_orders(keys, n, order)), Slow(TRAIN, order)
    for t, got in zip(TEST, model.scores(TEST)):
        assert got == pytest.approx(slow.log10(t), abs=1e-9)


def test_probabilities_add_up_to_one():
    keys, n = P.gram_counts(TRAIN, 4)
    model = P.Model(P.lower_orders(keys, n, 4))
    contexts = [0, *np.unique(keys >> np.uint64(8)).tolist(), 0x61626364, 0xFFFFFFFF]
    for c in contexts:
        p = 10 ** model.code(np.uint64(c << 8) | np.arange(256, dtype=np.uint64))
        assert p.sum() == pytest.approx(1.0, abs=1e-9)


def test_places():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 40, 5000).astype(np.uint64))
    table = P.Places(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1 << 41)) == -1).all()


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def check(docs, **how):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    tok = lambda b: re.findall(rb"[^\x20\x09-\x0D]+", b.lower()) + [b""]
    train = [b for i, b in rows if not _held(i)]
    c = Counter(w for b in train for w in tok(b))
    n, v = c.total(), len(c)
    slow = Slow(train, 2)
    got = sorted((tuple(r) for r in P.document_scores(docs, order=2, **how).collect()), key=lambda r: (str(r[0]), r[2], r[5]))
    want = sorted(((i, _held(i), len(tok(b)), sum(c[w] > 0 for w in tok(b)), n,
                    sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tok(b)), slow.log10(b)) for i, b in rows),
                  key=lambda r: (str(r[0]), r[2], r[5]))
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)


def test_awkward_rows(awkward):
    short = awkward.where("doc_id is null or doc_id not in (5, 6, 13)")
    check(short)
    check(short, max_frequent=3)          # most words go by the join


@pytest.mark.parametrize("max_edges", [10, 100])
def test_scores_are_of_the_whole_trie_whatever_part_is_broadcast(awkward, max_edges):
    check(awkward.where("doc_id is null or doc_id not in (5, 6, 13)"), max_edges=max_edges)


def test_long_texts_and_clashing_columns(awkward, crowded):
    check(awkward)
    assert P.document_scores(crowded, order=1).count() == awkward.count()


def test_the_broadcast_part_holds_the_same_share_at_every_size(spark):
    held = []
    for sf in ("sf0.001", "sf0.01"):
        counts = P.corpus_counts(read(spark, f"/root/testdata/{sf}", "documents"), 3)
        orders = P.fit(counts, 3, share=2.0 ** -12)
        assert all(len(np.unique(k >> np.uint64(8))) <= 2 ** 12 for k, _ in orders)
        held.append(orders[3][1].sum() / orders[0][1].sum())
    assert 0.5 < min(held) and max(held) - min(held) < 0.05


def test_the_model_is_cut_at_its_bound_and_stays_a_distribution(awkward):
    counts = P.corpus_counts(awkward, 3)
    orders = P.fit(counts, 3, max_edges=200)
    assert all(len(k) <= 200 for k, _ in orders[1:])
    model = P.Model(orders)
    for c in (0, 0x616263, 0x202020):
        assert (10 ** model.code(np.uint64(c << 8) | np.arange(256, dtype=np.uint64))).sum() == pytest.approx(1.0)


def test_held_out_texts_cost_less_than_with_a_shorter_memory(spark, small_dir):
    docs = read(spark, small_dir, "documents")
    total = [sum(r.score for r in P.document_scores(docs, order=k).where("held_out").collect()) for k in (0, 4)]
    assert total[1] > total[0]


def test_empty_and_no_training(spark, empty):
    assert P.document_scores(empty).count() == 0
    held = next(i for i in range(100) if _held(i))
    r = P.document_scores(spark.createDataFrame([(held, "ab")], "doc_id bigint, text string"), order=2).head()
    assert r.train_tokens == 0 and r.n_known == 0 and r.score == pytest.approx(-3 * math.log10(256))
