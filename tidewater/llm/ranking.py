"""Quality scores by Bradley-Terry ranking.

A document's strength is linear in features of its text.  Training pairs a
preferred document (label 1) with a worse one (label 0); the chance that the
first wins is the logistic function of the difference of their strengths, so
the weights are a logistic regression without intercept on feature
differences.  The cut is a quantile: the strength below which the training
rows hold as many documents as they have of label 0.  Scores map the cut to
``cut_score``, so ``score >= cut_score`` is the prediction.

Every labelled training document takes part in the fit and in the cut.
Features are made once for all documents and stored as counts, a fraction of
the text.  Training rows are dealt to blocks that hold both labels; pairs are
formed inside a block, so a Newton step is one pass over the blocks with one
sum of a gradient and a Hessian, and no pair is ever a row.

Features see the text only: never labels, language, source or id.  There are
twenty of the text's shape and ``BUCKETS`` of its content: the lower-cased
words and word pairs, hashed to buckets, the square roots of their counts
scaled to length one.  Without standardisation the ridge holds back the many
content weights until enough documents support them.  A very long text costs
time in proportion to its length; its features are no larger than others'.

Defined results: null and empty texts have the features of an empty text and
get a score; documents with contradictory labels teach nothing; without both
labels in the training rows every score is ``cut_score``; repeated rows each
get a row; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import numbered, stored

FEATURES = ("log_words", "word_length", "symbols", "upper", "digits", "stops", "marks", "pipes",
            "capitalised", "all_upper", "distinct_words", "top_word", "repeated_triples",
            "repeated_lines", "log_line_length", "symbol_words", "short_words", "long_words",
            "log_words_2", "blank")
#: Buckets of hashed words and word pairs.
BUCKETS = 512
#: Training rows of a block, and blocks of a task: a task sends one Hessian.
BLOCK, BLOCKS = 4096, 16
#: Byte classes: 1 symbols, 2 capitals, 3 digits, 4 stops, 5 marks; 0 all others.
_CLASS = np.zeros(256, dtype=np.int64)
for _kind, _bytes in enumerate((b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b".,;:", b"!?"), 1):
    _CLASS[list(_bytes)] = _kind


def text_features(text: str | None) -> list[float]:
    """The features of one text, each of moderate size."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    size = len(raw)
    kinds = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    by = np.bincount(_CLASS, weights=kinds, minlength=6) / size
    count = Counter(words)
    triples = max(n - 2, 1)
    distinct = len(set(zip(words, words[1:], words[2:]))) if n > 2 else 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    log_n = np.log1p(n)
    return [log_n, lengths.mean() / 10, by[1], by[2], by[3], by[4], by[5], kinds[124] / size,
            sum(w[:1].isupper() for w in words) / n, sum(w.isupper() and len(w) > 1 for w in words) / n,
            len(count) / n, max(count.values()) / n, 1 - distinct / triples,
            1 - len(set(lines)) / len(lines), np.log1p(size / len(lines)),
            sum(w[-1:] in b"#*$%&|<>" for w in words) / n, (lengths <= 2).mean(), (lengths > 20).mean(),
            log_n * log_n / 10, 0.0]


def content_counts(text: str | None) -> np.ndarray:
    """Counts by bucket of the hashed words and pairs of neighbouring words, lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    grams = np.concatenate([h * np.uint64(0xD6E8FEB86659FD93), pairs]) >> np.uint64(40)
    return np.bincount((grams % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)


def content_features(text: str | None) -> np.ndarray:
    """The square roots of the counts as a vector of length one (or zero)."""
    counts = np.sqrt(content_counts(text))
    size = np.sqrt((counts * counts).sum())
    return counts / size if size else counts


def features(text: str | None) -> np.ndarray:
    return np.concatenate([text_features(text), content_features(text)])


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and ``x``, the features of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))],
                                             names=["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>")


def _packed_counts(counts: np.ndarray) -> bytes:
    """The counts in the fewest bytes each that hold the largest (1, 2, 4 or 8), deflated."""
    return zlib.compress(counts.astype(np.min_scalar_type(int(counts.max()))).tobytes(), 1)


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, ``shape`` and ``grams`` of every row: the features, its counts packed in bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            shape = pa.array([text_features(t) for t in texts], pa.list_(pa.float64()))
            grams = pa.array([_packed_counts(content_counts(t)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), shape, grams], names=["doc_id", "shape", "grams"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, shape array<double>, grams binary")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The features of a batch's rows, from ``x`` or from ``shape`` and ``grams``."""
    n = batch.num_rows
    if "x" in batch.schema.names:
        return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    grams = map(zlib.decompress, batch.column("grams").to_pylist())
    counts = np.empty((n, BUCKETS))
    for i, g in enumerate(grams):
        counts[i] = np.frombuffer(g, dtype=f"u{len(g) // BUCKETS}")
    size = np.sqrt(counts.sum(axis=1, keepdims=True))
    content = np.sqrt(counts) / np.where(size > 0, size, 1.0)
    return np.concatenate([batch.column("shape").flatten().to_numpy().reshape(n, -1), content], axis=1)


def with_strength(rows: DataFrame, weights: list[float]) -> DataFrame:
    """doc_id, ``_row`` and ``s``, the strength of every row of ``counted``; features stay inside the task."""
    w = np.array(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_matrix(b) @ w, pa.float64())],
                                                 names=["doc_id", "_row", "s"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "_row", "shape", "grams").mapInArrow(run, f"doc_id {kind}, _row bigint, s double")


def fold(doc_id: Column, folds: int = 5) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def known_labels(labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id and label of the training fold, without contradictory ones."""
    return (labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
            .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
            .where("label = other").select("doc_id", "label"))


def training_sample(docs: DataFrame, labels: DataFrame, most: int, folds: int = 5) -> DataFrame:
    """doc_id, label and features of at most ``most`` labelled training documents, to look at."""
    chosen = known_labels(labels, folds).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.join(F.broadcast(chosen), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return stored(featured(texts).join(F.broadcast(chosen), "doc_id"), "ranking-sample")


def dealt(sample: DataFrame) -> tuple[DataFrame, int, int, int] | None:
    """(doc_id, label, block, place of every row; blocks, rows of label 1, of label 0); None without both labels.

    Rows of a label are dealt evenly by the order of a hash.  A label with
    fewer rows than there are blocks is repeated, so every block has both.
    """
    ids = sample.where("label in (0, 1)").select("doc_id", "label", *({"_row"} & set(sample.columns)))
    ranked, n = numbered(ids, [F.col("label"), F.xxhash64("doc_id", F.lit(3)), F.col("doc_id")], "ranking-order")
    n_bad = ranked.where("label = 0").count()
    n_good = n - n_bad
    if not n_good or not n_bad:
        return None
    blocks = -(-n // BLOCK)
    size = F.when(F.col("label") == 1, n_good).otherwise(n_bad).cast("long")
    place = F.when(F.col("label") == 1, F.col("_rank") - n_bad).otherwise(F.col("_rank"))
    one = F.array(F.floor(F.col("place") * blocks / F.col("size")).cast("long"))
    many = F.sequence(F.col("place"), F.lit(blocks - 1).cast("long"), F.col("size"))
    rows = ranked.select(*ids.columns, size.alias("size"), place.cast("long").alias("place"))
    block = F.explode(F.when(F.col("size") >= blocks, one).otherwise(many))
    return rows.select(*ids.columns, "place", block.alias("block")), blocks, n_good, n_bad


def rivals(n_good: int, n_bad: int, per_document: int) -> int:
    """Rivals of each label 1 document of a block: enough for every label 0 document to meet one."""
    return max(per_document, -(-n_bad // n_good))


def preference_pairs(sample: DataFrame, per_document: int, n_bad: int | None = None) -> DataFrame:
    """winner, loser, turn and the features a, b of both: the pairs that ``fit`` learns from, as rows.

    Rivals are dealt in turn, so a block's label 0 documents meet equally many (up to one).
    """
    block = Window.partitionBy("block", "label")
    ranked = dealt(sample)[0].select("*", (F.row_number().over(block.orderBy("place")) - 1).alias("r"),
                                     F.count(F.lit(1)).over(block).alias("size")).join(sample.drop("label"), "doc_id")
    bad = ranked.where("label = 0").select(F.col("doc_id").alias("loser"), F.col("x").alias("b"), "block",
                                           F.col("r").alias("rival"), F.col("size").alias("n_bad"))
    sizes = bad.groupBy("block").agg(F.first("n_bad").alias("n_bad"))
    good = ranked.where("label = 1").join(sizes, "block")
    turns = F.greatest(F.lit(per_document), F.ceil(F.col("n_bad") / F.col("size")).cast("int"))
    good = good.select(F.col("doc_id").alias("winner"), F.col("x").alias("a"), "block", "r", "n_bad",
                       turns.alias("turns"), F.explode(F.sequence(F.lit(0), turns - 1)).alias("k"))
    good = good.withColumn("rival", F.pmod(F.col("r") * F.col("turns") + F.col("k"), F.col("n_bad"))).drop("n_bad")
    return good.join(bad, ["block", "rival"]).select("winner", "loser", F.pmod("k", F.lit(2)).alias("turn"), "a", "b")


def _block_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray, per_document: int):
    """(pairs, loss, gradient, Hessian) of a block's pairs, without the ridge."""
    turns = rivals(len(good), len(bad), per_document)
    sg, sb = good @ w, bad @ w
    dg, db, hg, hb = np.zeros(len(good)), np.zeros(len(bad)), np.zeros(len(good)), np.zeros(len(bad))
    met, loss = np.zeros(good.shape, np.float32), 0.0
    low = bad.astype(np.float32)
    for k in range(turns):
        rival = (np.arange(len(good)) * turns + k) % len(bad)
        gap = sg - sb[rival]
        loss += np.logaddexp(0.0, -gap).sum()
        lose = np.exp(-np.logaddexp(0.0, gap))                    # chance that the worse one wins
        bend = lose * (1 - lose)
        dg += lose
        hg += bend
        db += np.bincount(rival, weights=lose, minlength=len(bad))
        hb += np.bincount(rival, weights=bend, minlength=len(bad))
        met += bend[:, None].astype(np.float32) * low[rival]
    high = good.astype(np.float32)
    cross = high.T @ met
    hessian = (high * hg[:, None].astype(np.float32)).T @ high + (low * hb[:, None].astype(np.float32)).T @ low - cross - cross.T
    return len(good) * turns, loss, bad.T @ db - good.T @ dg, hessian.astype(np.float64)


def _sums(rows: DataFrame, w: np.ndarray, per_document: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss, gradient and Hessian over all pairs; ``rows`` hold whole blocks in order."""
    size = len(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, now, parts = np.zeros((size + 2, size)), None, []

        def close() -> None:
            labels = np.concatenate([p[0] for p in parts])
            x = np.concatenate([p[1] for p in parts])
            n, loss, gradient, hessian = _block_sums(x[labels == 1], x[labels == 0], w, per_document)
            total[0, :2] += n, loss
            total[1] += gradient
            total[2:] += hessian

        for b in batches:
            if not b.num_rows:
                continue
            block, label, x = b.column("block").to_numpy(), b.column("label").to_numpy(), _matrix(b)
            starts = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
            for i, j in zip(starts, [*starts[1:], len(block)]):
                if parts and block[i] != now:
                    close()
                    parts = []
                now = block[i]
                parts.append((label[i:j], x[i:j]))
        if parts:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 2), pa.int32()),
                                              pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    each = rows.mapInArrow(run, "i int, v array<double>").groupBy("i").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
    total = np.array([r.v.toArray() for r in sorted(each.collect())])       # one row per feature
    n, loss = total[0, :2]
    return loss / n, total[1] / n, total[2:] / n


def blocked(places: DataFrame, features: DataFrame, key: str, blocks: int) -> DataFrame:
    """The features of the dealt rows in whole blocks, ``BLOCKS`` to a task; they are dealt by key and by block at any size."""
    rows = features.hint("merge").join(places.select(key, "label", "block", "place"), key)
    rows = rows.repartition(-(-blocks // BLOCKS), "block").sortWithinPartitions("block", "label", "place")
    return rows.drop("doc_id", "_row", "place")


def fit(sample: DataFrame, per_document: int = 4, ridge: float = 1e-3, tol: float = 1e-7,
        max_iter: int = 50, counts: DataFrame | None = None) -> list[float] | None:
    """Weights of the features, from ``per_document`` pairs of each preferred document.

    The features are the sample's ``x``, or those of ``counts`` at the sample's ``_row``.

    Newton's method on mean log(1 + exp(-w(a - b))) + ridge |w|^2 / 2; a step that does not lower it is halved.
    """
    order = dealt(sample)
    if order is None:
        return None
    places, blocks, _, _ = order
    rows = (blocked(places, sample.select("doc_id", "x"), "doc_id", blocks) if counts is None else
            blocked(places, counts.drop("doc_id"), "_row", blocks)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        w = np.zeros(len(FEATURES) + BUCKETS)
        step, best, first = None, None, None
        for _ in range(max_iter):
            at = w if step is None else w + step
            loss, gradient, hessian = _sums(rows, at, per_document)
            loss += ridge * (at @ at) / 2
            if best is not None and loss > best + 1e-12:
                step = step / 2
                continue
            w, best = at, loss
            gradient = gradient + ridge * w
            size = np.linalg.norm(gradient)
            first = size if first is None else first
            if size <= tol * first:
                break
            step = -np.linalg.solve(hessian + ridge * np.eye(len(w)), gradient)
    finally:
        rows.unpersist()
    return [float(c) for c in w]


def quantile(values: DataFrame, share: float) -> float:
    """The exact quantile of the column ``s``, interpolated between neighbours; rows are ranked by range."""
    ranked, n = numbered(values.select("s"), [F.col("s")], "ranking-strengths")
    at = share * (n - 1)
    low = int(at)
    near = [r.s for r in ranked.where(F.col("_rank").between(low, low + 1)).orderBy("_rank").collect()]   # two rows
    return near[0] + (at - low) * (near[-1] - near[0])


def document_scores(docs: DataFrame, labels: DataFrame, cut_score: float = 0.3, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = stored(counted(docs).withColumn("_row", F.monotonically_increasing_id()), "ranking-features")
    chosen = stored(rows.select("doc_id", "_row").join(known_labels(labels, folds), "doc_id")
                    .groupBy("doc_id").agg(F.min("_row").alias("_row"), F.first("label").alias("label")), "ranking-rows")
    weights = fit(chosen, counts=rows)
    if weights is None:
        out, score = rows, F.lit(float(cut_score))
    else:
        out = stored(with_strength(rows, weights), "ranking-scored")
        share = chosen.agg(F.avg(F.when(F.col("label") == 0, 1.0).otherwise(0.0))).head()[0]
        cut = quantile(out.select("_row", "s").join(chosen.select("_row"), "_row"), share)
        score = 1 / (1 + F.exp(-(F.col("s") - float(cut))) * (1 - cut_score) / cut_score)
    out = out.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= cut_score).cast("int"))
