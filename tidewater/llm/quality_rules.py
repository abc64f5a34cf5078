"""Quality rules: n-gram likelihood ratio of trusted texts against the raw corpus.

Base rules count words, symbols, repeated lines and repeated three-word
windows.  The method's verdict compares two multinomials over hashed word
1- and 2-grams (``buckets`` of them): one counted on trusted texts, one on the
whole raw corpus, both with add-one smoothing.  A document's score is its log
likelihood ratio divided by its number of n-grams; it is kept if the score is
at least ``threshold``, a fixed number, so a document's verdict depends on the
document and the two models alone.

The corpus counts shuffle ``buckets`` rows per task at most; to tell trusted
texts, the documents' bucket numbers (two bytes an n-gram) are joined with the
trusted doc_ids, in the same way at every size.  The model (``buckets``
numbers, a fixed size) goes into the scoring expression as a literal.  Nothing depends on a document's neighbours,
so hot sources or groups of copies do not matter.

Defined results: a null text has no words and fails the base rules like an
empty one; without trusted texts there is no verdict and the base rules
decide; repeated rows each get a row; an empty table gives none; extra columns
are kept by ``kept_rows`` and ignored by ``document_quality``.  A text of any
length is judged whole, as one row of one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import packed, words

SYMBOLS = r"[#*$%&|<>]"
BLANKS = " \t\n\x0b\x0c\r"
WIDTH = 3                                     # words of a repeated window
BUCKETS, THRESHOLD = 8192, -0.07


def _next(col: str, both) -> Column:
    """both(x, y) for each element x of an array column and the one after it (null at the end)."""
    return F.zip_with(F.col(col), F.slice(col, 2, F.greatest(F.size(col) - 1, F.lit(0))), both)


def word_features(docs: DataFrame) -> DataFrame:
    """docs plus the base columns of the rules and ``_h``, the hashes of the words in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn("_h", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)))
    last = F.size("_h") - WIDTH
    out = out.withColumn("_g", F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: (
        F.xxhash64(*[F.col("_h")[i + k] for k in range(WIDTH)])))))
    # Only documents with a repeated window pay for sorting: windows sorted by
    # hash and place, neighbours with equal hashes are the repeated ones.
    out = out.withColumn("_g", F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    twice = _next("_g", lambda x, y: F.when(x["g"] == y["g"], F.array(x["i"], y["i"])))
    out = out.withColumn("_g", F.array_sort(F.array_distinct(F.flatten(
        F.filter(twice, lambda p: p.isNotNull())))))
    # each repeated window adds the words up to the next one's start, WIDTH at most
    fresh = _next("_g", lambda x, y: F.least(F.lit(WIDTH), F.coalesce(y - x, F.lit(WIDTH))))
    out = out.withColumn("_g", F.coalesce(
        F.aggregate(fresh, F.lit(0).cast("long"), lambda s, g: s + g), F.lit(0).cast("long")))
    out = out.withColumn("_l", F.filter(F.split(text, "\n"), lambda x: F.length(
        F.translate(x, BLANKS, "")) > 0))
    n = F.size("_h").cast("long")
    return out.withColumns({
        "n_words": n,
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": F.col("_g"),
        "base_failed": (n < 50) | (100 * F.col("_g") > 50 * n),
    }).drop("_g", "_l")


def gram_buckets(h: Column, buckets: int) -> Column:
    """Bucket numbers of the 1- and 2-grams of an array of word hashes."""
    one = F.transform(h, lambda x: F.pmod(x, F.lit(buckets)))
    two = F.transform(F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))),
                      lambda x, i: F.pmod(F.xxhash64(h[i], x), F.lit(buckets)))
    return F.concat(one, two)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_ids of trusted texts: all that are labelled 1."""
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()


def fit(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """log p_trusted - log p_raw of each bucket: raw counts over all of ``docs``.

    ``trusted``: distinct doc_ids (``trusted_ids``), of any number: always a merge join, of which the
    documents' side holds two bytes an n-gram, its bucket number.
    """
    if not 0 < buckets <= 1 << 15:
        raise ValueError("bucket numbers are 16-bit: buckets must be 1 to 32768")
    hashes = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    # the hashes are bound to a name, so they are made once and not for each n-gram
    grams = F.transform(F.array(hashes), lambda h: gram_buckets(h, buckets).cast("array<smallint>"))[0]
    marked = docs.select("doc_id", grams.alias("_b"))
    marked = marked.join(trusted.withColumn("_ok", F.lit(1)).hint("merge"), "doc_id", "left")
    counts = (marked.select("_ok", F.explode("_b").alias("b"))
              .groupBy("b").agg(F.count("*").alias("raw"), F.count("_ok").alias("trusted")))
    raw, good = [0] * buckets, [0] * buckets
    for b, x, y in counts.collect():              # ``buckets`` rows at most
        raw[b], good[b] = x, y
    r, t = sum(raw) + buckets, sum(good) + buckets
    if t == buckets:
        return [0.0] * buckets
    return [math.log((y + 1) / t) - math.log((x + 1) / r) for x, y in zip(raw, good)]


def ratio(hashes: str, model: list[float]) -> Column:
    """Mean log likelihood ratio of the n-grams of an array column of word hashes."""
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    total = F.aggregate(gram_buckets(F.col(hashes), len(model)), F.lit(0.0),
                        lambda s, b: s + F.get(table, b.cast("int")))
    return F.when(F.size(hashes) > 0, total / (2 * F.size(hashes) - 1))


def judged(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS,
           threshold: float = THRESHOLD) -> DataFrame:
    """docs plus the base columns, ``ratio`` and ``kept``."""
    model = fit(docs, trusted, buckets)
    out = word_features(docs).withColumn("ratio", ratio("_h", model)).drop("_h")
    # Always true, but not foldable: a filter on ``kept`` stays above these
    # columns.  Pushed below them it would repeat their expressions many times over.
    here = F.monotonically_increasing_id() >= 0
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold) & here)


def document_quality(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    return judged(docs.select("doc_id", "text"), trusted_ids(labels), **how).drop("text")


def kept_rows(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents that pass the base rules and the ratio test."""
    rows = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    return judged(rows, trusted_ids(labels), **how).where("kept").select("_row.*")
