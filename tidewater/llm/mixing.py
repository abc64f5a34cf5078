"""Mixing sources to target weights over blocks of packed tokens.

1. Every source's documents, in a fixed order, form one stream of words that
   is cut into blocks of ``block_words`` (documents are packed, not padded).
2. Targets: the sources share ``share`` times all words by weight; a target
   stops at ``most`` times its source's words and the excess is shared again.
3. Output slots are grouped into output shards.  A shard's count of each
   source is a multinomial draw, conditioned on every source's total being
   its target: that is the multivariate hypergeometric law, and it is drawn
   exactly by laying the sources' quotas end to end and letting a Feistel
   permutation of all slots deal them out.
4. A source's k-th slot reads block ``perm(k mod blocks)``, with another
   permutation for each pass over the source.  The last slot takes only the
   words that its source's target still lacks.
5. Blocks are joined by (source, index): ``mixed_blocks`` gives the words of
   every slot of every output shard, ``mix_documents`` what they take of each
   document.

No step holds a source in one task: streams are built from lanes (a hash of
the row) per source, whose sums give each lane's offset; there is a lane for
every ``ROWS_A_LANE`` rows of the table, and ``LEAST_LANES`` at least.  All
tables but the per-source one (a row per source) are dealt by keys that spread.

Defined results: null is a source of its own, last in order, "" the first;
null and empty texts have size 0 and are never taken; equal rows are
interchangeable; an empty table mixes to nothing; extra columns are kept.  A
very long text is cut into as many pieces as it has blocks, in one row's task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import feistel, packed, row_hash, stored, word_count, words

WEIGHTS = (3.0, 1.0, 2.0)
CHUNK, MAX_TASKS = 4096, 20_000
ROWS_A_LANE, LEAST_LANES = 4096, 1024


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0,
                   weights=WEIGHTS) -> DataFrame:
    """(source, source_size) -> with pos (order by code point, null last) and target.

    One narrow row per source.  Each turn of the loop is one sum over them;
    the set of sources at their cap only grows, so it ends.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    src = sizes.withColumn("pos", (F.row_number().over(by_name) - 1).cast("long"))
    src = stored(src.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.pmod("pos", F.lit(len(weights))) + 1).cast("int"))),
        "mix-sources")
    cap, w = F.col("source_size") * F.lit(most), F.col("weight")
    total = src.agg(F.sum("source_size")).head()[0] or 0
    level, held = 0.0, -1
    while total:
        over = (cap < w * F.lit(level)) if held >= 0 else F.lit(False)
        n, full, free = src.agg(F.count_if(over), F.sum(F.when(over, cap).otherwise(0.0)),
                                F.sum(F.when(over, 0.0).otherwise(w))).head()
        if n == held or not free:
            break
        held, level = n, (share * total - full) / free
    return src.withColumn("target", F.least(cap, w * F.lit(level)).cast("double"))


def quotas(src: DataFrame, block_words: int) -> DataFrame:
    """Blocks and slots of each source, where its slots start among all quotas, and the words its
    last slot takes (the others take their whole block)."""
    size, target, n = F.col("source_size"), F.col("target"), F.col("blocks")
    src = src.withColumn("blocks", F.ceil(size / block_words).cast("long"))
    passes = F.when(size > 0, F.floor(target / size)).otherwise(0)
    rest = F.round(target - passes * size).cast("long")               # words beyond the whole passes
    src = src.withColumn("slots", (passes * n + F.ceil(rest / block_words)).cast("long"))
    src = src.withColumn("last_words", F.when(rest % block_words > 0, rest % block_words).otherwise(block_words))
    before = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return src.withColumn("slot_start", F.coalesce(F.sum("slots").over(before), F.lit(0)))


def draw_slots(src: DataFrame, total_slots: int, blocks_per_shard: int, seed: int) -> DataFrame:
    """Every output slot: shard, place in it, source position, pass, block index, and whether it is
    its source's last, with the words that one takes."""
    first = F.explode(F.sequence(F.lit(0).cast("long"),
                                 F.floor((F.col("slots") - 1) / CHUNK).cast("long")))
    chunks = (src.where("slots > 0").select("pos", "blocks", "slots", "slot_start", "last_words",
                                            first.alias("chunk"))
              .repartition(min(total_slots // CHUNK + 1, MAX_TASKS), "pos", "chunk"))
    k = chunks.select("pos", "blocks", "slots", "slot_start", "last_words", F.explode(F.sequence(
        F.col("chunk") * CHUNK,
        F.least((F.col("chunk") + 1) * CHUNK, F.col("slots")) - 1)).alias("k"))
    at = feistel(F.col("slot_start") + F.col("k"), F.lit(total_slots).cast("long"),
                 F.lit(seed).cast("long"))
    turn = F.floor(F.col("k") / F.col("blocks")).cast("long")
    index = feistel(F.pmod("k", F.col("blocks")), F.col("blocks"),
                    F.xxhash64(F.col("pos"), turn, F.lit(seed)))
    return (k.withColumn("at", at)
            .select("pos", turn.alias("turn"), index.alias("block"),
                    F.floor(F.col("at") / blocks_per_shard).cast("long").alias("shard"),
                    F.pmod("at", F.lit(blocks_per_shard)).alias("place"),
                    F.when(F.col("k") == F.col("slots") - 1, F.col("last_words")).alias("most_words")))


def shard_counts(slots: DataFrame) -> DataFrame:
    """The draws themselves: blocks of each source in each output shard."""
    return slots.groupBy("shard", "pos").agg(F.count("*").alias("n_blocks"))


def block_uses(slots: DataFrame) -> DataFrame:
    """How often each block is taken.  As many rows as the mix has blocks: never to be broadcast,
    though the plan, which only knows the small table of sources, would estimate it as tiny."""
    return slots.groupBy("pos", "block").agg(F.count("*").alias("uses")).hint("merge")


def lane_count(n_rows: int) -> int:
    """Lanes per source for a table of so many rows, whatever their sources: a lane of the largest
    possible source still has about ``ROWS_A_LANE`` rows."""
    return max(LEAST_LANES, -(-n_rows // ROWS_A_LANE))


def streams(rows: DataFrame, src: DataFrame, lanes: int) -> DataFrame:
    """(source, size, key...) rows with ``pos`` and ``start``, the words before them in their source."""
    rows = rows.withColumn("lane", F.pmod(F.xxhash64("key", "size"), F.lit(lanes)))
    sums = rows.groupBy("source", "lane").agg(F.sum("size").alias("lane_size"))
    up_to = Window.partitionBy("source").orderBy("lane")
    sums = sums.withColumn("lane_start", F.sum("lane_size").over(up_to) - F.col("lane_size"))
    sums = sums.alias("s").join(src.select("source", "pos").alias("t"),
                                F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        "s.source", "lane", "lane_start", "pos")
    in_lane = Window.partitionBy("source", "lane").orderBy("key", "size")
    placed = rows.withColumn("in_lane", F.sum("size").over(
        in_lane.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    cond = F.col("p.source").eqNullSafe(F.col("l.source")) & (F.col("p.lane") == F.col("l.lane"))
    return placed.alias("p").join(sums.alias("l"), cond).select(
        "p.*", "pos", (F.col("lane_start") + F.col("in_lane")).alias("start")).drop("lane", "in_lane")


def plan(rows: DataFrame, block_words: int, blocks_per_shard: int, seed: int, lanes: int | None,
         share: float, most: float):
    """(placed rows, sources, slots) for rows with ``source``, ``size`` and ``key``."""
    rows = stored(rows, "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    src = stored(quotas(source_targets(sizes, share, most), block_words), "mix-quotas")
    total, n_rows = (x or 0 for x in src.agg(F.sum("slots"), F.sum("n_rows")).head())
    return streams(rows, src, lanes or lane_count(n_rows)), src, draw_slots(src, total, blocks_per_shard, seed)


def slot_parts(docs: DataFrame, block_words: int, blocks_per_shard: int, seed: int, lanes: int | None,
               share: float, most: float):
    """(slots with their blocks' parts, placed rows, sources).

    ``parts`` of a slot: start in the source, size and doc_id of each document
    in its block, and that document's words there, parted by blanks.
    """
    keyed = docs.select("doc_id", "source", "text", word_count(F.col("text")).alias("size"),
                        F.xxhash64("doc_id", "text").alias("key"))
    rows = keyed.select("doc_id", "source", "size", "key")
    placed, src, slots = plan(rows, block_words, blocks_per_shard, seed, lanes, share, most)
    slots = stored(slots, "mix-slots")
    L, start, end = F.lit(block_words), F.col("start"), F.col("start") + F.col("size")

    def pieces(found: Column) -> Column:                 # the words are found once per document
        return F.transform(F.sequence(F.floor(start / L), F.floor((end - 1) / L)), lambda b: F.struct(
            b.alias("block"), F.array_join(F.slice(
                found, (F.greatest(start, b * L) - start + 1).cast("int"),
                (F.least(end, (b + 1) * L) - F.greatest(start, b * L)).cast("int")), " ").alias("words")))

    texts = keyed.where("size > 0").select("key", "text").dropDuplicates(["key"])
    cut = placed.where("size > 0").select("key", "doc_id", "pos", "start", "size").join(texts.hint("merge"), "key")
    cut = cut.select("doc_id", "pos", "start", "size", F.explode(F.flatten(
        F.transform(F.array(words(F.col("text"))), pieces))).alias("piece"))
    blocks = cut.groupBy("pos", F.col("piece.block").alias("block")).agg(F.array_sort(F.collect_list(
        F.struct("start", "size", "doc_id", F.col("piece.words").alias("words")))).alias("parts"))
    filled = slots.hint("merge").join(blocks.hint("merge"), ["pos", "block"])
    return filled.withColumn("parts", F.when(F.col("most_words") < L, first_words(L)).otherwise(F.col("parts"))), placed, src


def first_words(block_words: Column) -> Column:
    """The parts of a block up to its first ``most_words`` words."""
    def at(p: Column) -> Column:                          # where in the block the part begins
        return F.greatest(p["start"] - F.col("block") * block_words, F.lit(0))

    def cut(p: Column) -> Column:
        found = F.slice(F.split(p["words"], " "), 1, (F.col("most_words") - at(p)).cast("int"))
        return F.struct(p["start"].alias("start"), p["size"].alias("size"), p["doc_id"].alias("doc_id"),
                        F.array_join(found, " ").alias("words"))

    return F.transform(F.filter("parts", lambda p: at(p) < F.col("most_words")), cut)


def mixed_blocks(docs: DataFrame, block_words: int = 256, blocks_per_shard: int = 4096,
                 seed: int = 11, lanes: int | None = None, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: shard, place, source and the words of every output slot."""
    filled, _, src = slot_parts(docs, block_words, blocks_per_shard, seed, lanes, share, most)
    text = F.array_join(F.transform("parts", lambda p: p["words"]), " ")
    return filled.join(src.select("pos", "source"), "pos").select(
        "shard", "place", "source", F.split(text, " ").alias("words"))


def mix_documents(docs: DataFrame, block_words: int = 256, blocks_per_shard: int = 4096,
                  seed: int = 11, lanes: int | None = None, share: float = 1.5,
                  most: float = 2.0) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken.

    ``taken`` is counted on the words of the filled slots, shard by shard.
    """
    filled, placed, src = slot_parts(docs, block_words, blocks_per_shard, seed, lanes, share, most)
    part = filled.select("shard", "pos", F.explode("parts").alias("part")).select(
        "shard", "pos", "part.start", F.size(F.split("part.words", " ")).alias("n"))
    taken = (part.groupBy("shard", "pos", "start").agg(F.sum("n").alias("n"))
             .groupBy("pos", "start").agg(F.sum("n").alias("taken")))    # (pos, start) is unique where size > 0
    some = placed.where("size > 0").join(taken.hint("merge"), ["pos", "start"], "left").select(
        "pos", "size", "doc_id", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    none = placed.where("size = 0").select("pos", "size", "doc_id", F.lit(0).cast("long").alias("taken"))
    return some.unionByName(none).join(src.select("pos", "source_size", "target"), "pos").select(
        "doc_id", "size", "source_size", "target", "taken")


def mixed_rows(docs: DataFrame, block_words: int = 256, blocks_per_shard: int = 4096,
               seed: int = 11, lanes: int | None = None, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed corpus as whole rows: each document once for every use of the block it begins in.

    Used where the output must keep the documents whole; on average a
    document appears target / source size times.  A last slot counts as a use
    if it takes at least half a block.  Equal rows count together.
    """
    keyed = packed(docs, source=F.col("source"), key=row_hash(docs), size=word_count(F.col("text")))
    rows = keyed.select("key", "source", "size")
    placed, _, slots = plan(rows, block_words, blocks_per_shard, seed, lanes, share, most)
    uses = block_uses(slots.where(F.coalesce(F.col("most_words") * 2 >= block_words, F.lit(True))))
    begun = placed.where("size > 0").select(
        "key", "size", "pos", F.floor(F.col("start") / block_words).alias("block"))
    copies = (begun.join(uses, ["pos", "block"]).groupBy("key", "size")
              .agg(F.sum("uses").cast("int").alias("copies")))
    one = keyed.dropDuplicates(["key", "size"])           # all of the equal rows' copies come of one
    return (one.join(copies, ["key", "size"])
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("_row.*"))
