"""Benchmark decontamination by spaced-seed hashing.

A spaced seed hashes the words at the kept positions of a fixed mask and
ignores the others, so a changed word under an ignored position does not hide
a hit.  Benchmark and documents are hashed under the same masks and joined on
the hash; every hit is then checked on its diagonal: of some ``window``
aligned words that include the seed (the whole item if it is shorter), at
least ``least`` must be equal.  Words are runs of letters, marks and digits,
lower-cased, so punctuation and case do not matter.

Documents never move: their seeds are made, looked up and checked in the scan
stage, and only confirmed (document, item) pairs are shuffled.  The benchmark
is broadcast in blocks whose number of seeds is checked against
``block_seeds``; a larger benchmark takes more passes, a very long item is cut
into overlapping segments, and so is a long document: time is linear in a text.

Defined results: null and empty texts or items never match, null ids are
kept as such; equal doc_ids or item_ids report together; extra columns are
carried by ``decontaminated`` and ignored by ``matches``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import packed, row_hash, stored

TOKEN = r"[\p{L}\p{M}\p{N}]+"
#: (least words of an item, its masks); 1 keeps a position, 0 ignores it.  Each family keeps some
#: place free of changes in every window that may differ in a fifth of its words (enumerated in tests).
FAMILIES = ((12, ("11001011", "11010011")), (4, ("1101", "1011")), (3, ("111",)), (2, ("11",)), (1, ("1",)))
SEGMENT, DOC_SEGMENT = 4096, 1024


def token_hashes(text: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return F.transform(found, lambda w: F.xxhash64(w))


def seeds(hashes: str, mask: str) -> Column:
    """Seed hashes of one mask at every position of an array column of word hashes."""
    kept = [i for i, c in enumerate(mask) if c == "1"]
    last = F.size(hashes) - len(mask)
    col = F.col(hashes)
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last),
        lambda p: F.xxhash64(F.lit(mask), *[col[p + i] for i in kept]))).otherwise(
        F.array().cast("array<bigint>"))


def _family(n: Column) -> Column:
    """The family of masks for an item of n words, named by its least number of words."""
    out = F.lit(0)
    for words, _ in reversed(FAMILIES):
        out = F.when(n >= words, F.lit(words)).otherwise(out)
    return out


def segments(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, item words of at most SEGMENT + window, and the family of their masks."""
    items = benchmark.select("item_id", token_hashes(F.col("text")).alias("all"))
    step = F.greatest(F.ceil((F.size("all") - window) / SEGMENT), F.lit(1)) - 1
    cut = items.where(F.size("all") > 0).select("item_id", "all", F.explode(
        F.sequence(F.lit(0), step.cast("int"))).alias("seg"))
    cut = cut.select("item_id", F.slice("all", F.col("seg") * SEGMENT + 1, F.lit(SEGMENT + window))
                     .alias("item"))
    return cut.withColumn("family", _family(F.size("item"))).withColumn(
        "seg_id", F.xxhash64("item_id", "item")).dropDuplicates(["seg_id"])


def document_segments(docs: DataFrame, key: list[str], window: int) -> DataFrame:
    """key..., doc (words of at most DOC_SEGMENT and some before and after), doc_start.

    Segments overlap by what a window around a seed may need, so every seed has a segment that
    holds its windows whole.  A seed's row then carries words of bounded number, and a text's
    cost grows with its length.
    """
    longest = max(len(m) for _, masks in FAMILIES for m in masks)
    words = docs.select(*key, token_hashes(F.col("text")).alias("all"))
    last = F.greatest(F.ceil(F.size("all") / DOC_SEGMENT), F.lit(1)) - 1
    cut = words.select(*key, "all", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("seg"))
    start = F.greatest(F.col("seg") * DOC_SEGMENT - window, F.lit(0))
    stop = (F.col("seg") + 1) * DOC_SEGMENT + longest + window
    return cut.select(*key, F.slice("all", start + 1, stop - start).alias("doc"), start.alias("doc_start"))


def matches(docs: DataFrame, benchmark: DataFrame, key: list[str] = ("doc_id",), window: int = 13,
            least: float = 0.8, block_seeds: int = 500_000) -> DataFrame:
    """Confirmed overlaps: key..., item_id, words (equal words of the best window), first, last."""
    parts = stored(segments(benchmark, window), "decontam-items")
    cost = F.size("item") * 3
    bound = max(block_seeds, parts.agg(F.max(cost)).head()[0] or 0)     # a segment is never parted
    n_blocks = 1
    while True:                                   # the size of each broadcast is checked
        sized = parts.withColumn("block", F.pmod("seg_id", F.lit(n_blocks)))
        if (sized.groupBy("block").agg(F.sum(cost).alias("n")).agg(F.max("n")).head()[0] or 0) <= bound:
            break
        n_blocks *= 2
    blocks = {tuple(r) for r in sized.select("block", "family").distinct().collect()}   # one per pass
    base = document_segments(docs, list(key), window)
    hits = [_hits(base, sized.where(F.col("block") == b), words, masks, list(key), window, least)
            for b, f in sorted(blocks) for words, masks in FAMILIES if words == f]
    if not hits:
        hits = [_hits(base, sized, 1, ("1",), list(key), window, least)]
    found = hits[0]
    for more in hits[1:]:
        found = found.unionByName(more)
    return found.groupBy(*key, "item_id").agg(
        F.max("words").alias("words"), F.min("first").alias("first"), F.max("last").alias("last"))


def _hits(base: DataFrame, items: DataFrame, family: int, masks, key: list[str], window: int,
          least: float) -> DataFrame:
    items, span = items.where(F.col("family") == family), len(masks[0])
    of_item = items.select("seg_id", F.posexplode(F.concat(*[seeds("item", m) for m in masks])),
                           F.size("item").alias("n_item"))
    of_item = of_item.select(F.col("col").alias("seed"), "seg_id", F.pmod(
        "pos", F.col("n_item") - span + 1).alias("item_at"))
    of_doc = base.select(*key, "doc", "doc_start", F.posexplode(F.concat(*[seeds("doc", m) for m in masks])))
    of_doc = of_doc.select(*key, "doc", "doc_start", F.col("col").alias("seed"),
                           F.pmod("pos", F.size("doc") - span + 1).alias("doc_at"))
    hit = (of_doc.join(F.broadcast(of_item), "seed")
           .join(F.broadcast(items.select("seg_id", "item_id", "item")), "seg_id"))
    hit = hit.withColumns({"diag": F.col("doc_at") - F.col("item_at"),
                           "w": F.least(F.lit(window), F.size("item"))})
    # aligned item positions of the windows that hold the whole seed
    lo = F.greatest(F.lit(0), -F.col("diag"), F.col("item_at") + span - F.col("w"))
    hi = F.least(F.size("item"), F.size("doc") - F.col("diag"), F.col("item_at") + F.col("w"))
    hit = hit.withColumns({"lo": lo, "hi": hi}).where("hi - lo >= w")
    equal = F.transform(F.sequence("lo", F.col("hi") - 1), lambda k: (
        F.col("item")[k] == F.col("doc")[k + F.col("diag")]).cast("int"))
    hit = hit.withColumn("equal", equal)
    best = F.array_max(F.transform(
        F.sequence(F.lit(0), F.col("hi") - F.col("lo") - F.col("w")),
        lambda s: F.aggregate(F.slice("equal", s + 1, F.col("w")), F.lit(0), lambda x, y: x + y)))
    return (hit.withColumn("words", best).where(F.col("words") >= F.col("w") * F.lit(least))
            .select(*key, "item_id", "words", (F.col("doc_start") + F.col("doc_at")).alias("first"),
                    (F.col("doc_start") + F.col("doc_at") + span - 1).alias("last")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents that overlap no benchmark item."""
    keyed = packed(docs, _row_key=row_hash(docs), text=F.col("text"))
    bad = matches(keyed, benchmark, key=["_row_key"], **how).select("_row_key").distinct()
    return keyed.join(stored(bad, "decontam-found"), "_row_key", "left_anti").select("_row.*")
