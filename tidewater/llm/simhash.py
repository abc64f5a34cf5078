"""SimHash near-duplicates: 64-bit fingerprints joined on a binary trie.

A document's fingerprint takes the XXH64 (seed 42) of every shingle of its
lower-cased words; a bit is set if it is set in more than half the hashes.
Two documents are linked if their fingerprints differ in at most ``budget``
bits; classes are the connected components.

**Links.**  Equal fingerprints are first put together, so a large group of
copies is one entry.  The distinct fingerprints form a binary trie that is
joined with itself: a pair of nodes is replaced by its pairs of children, a
pair's differing bits add up on the way down, and a pair over the budget is
dropped with everything below it.  The upper levels run as Spark joins, the
lower ones inside tasks:

* Two fingerprints within the budget agree on at least one of ``budget + 1``
  parts of the 64 bits.  There is one trie per part, with that part's bits on
  top, in which only equal upper nodes have to be paired; pairs whose upper
  bits differ meet in another trie.
* Node pairs with more than ``node_rows`` fingerprints go down ``STEP`` more
  levels by a shuffle, until every pair is small: no node is one task's load.
* A task walks down all its node pairs together, level by level.

**Components.**  Labels spread over the links with pointer jumping, each turn
written to the shared folder; nothing of it passes through the driver but
counts.

Defined results: null, empty and blank texts have fingerprint 0, linked like
any other; fewer words than a shingle are one shingle; repeated rows and
doc_ids each give a row; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import packed, row_hash, stored

BITS, STEP, SEED = 64, 6, 42


# ------------------------------------------------------------ fingerprints

def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of one text."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(tokens), SEED)
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    count, total = np.zeros(BITS, dtype=np.int64), len(tokens) - shingle + 1
    spans = list(zip(starts, ends[shingle - 1:].tolist()))
    for at in range(0, total, 65536):            # bounded memory for very long texts
        h = np.array([digest(joined[a:b], SEED) for a, b in spans[at:at + 65536]], dtype=">u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, row_key (content hash of the row) and fp (signed 64-bit) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()],
                           dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                names=["doc_id", "row_key", "fp"])

    slim = docs.select("doc_id", row_hash(docs).alias("_row_key"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, row_key bigint, fp bigint")


# -------------------------------------------------------- trie, inside tasks

def trie_pairs(group: np.ndarray, a: np.ndarray, v: np.ndarray, is_self: np.ndarray,
               depth: np.ndarray, diff: np.ndarray, budget: int):
    """Pairs (i, j) of rows whose values differ in at most ``budget`` bits.

    Rows are sorted by (group, side ``a`` first, value).  Group g is a node
    pair: with itself if ``is_self[g]``, else its side-a rows with the others;
    the values' first ``depth[g]`` bits differ in ``diff[g]`` places already.
    """
    n, n_groups = len(v), len(is_self)
    lo = np.searchsorted(group, np.arange(n_groups), "left")
    hi = np.searchsorted(group, np.arange(n_groups), "right")
    ones = np.concatenate([[0], np.cumsum(~a)])
    mid = hi - (ones[hi] - ones[lo])
    same = is_self
    # one line per node pair: range of one node, range of the other, differing bits, next bit
    state = [np.column_stack([np.where(same, lo, lo), np.where(same, hi, mid),
                              np.where(same, lo, mid), hi, diff, depth, same])]
    found = []
    for bit in range(BITS):
        pairs = np.concatenate(state)
        later, now = pairs[pairs[:, 5] > bit], pairs[pairs[:, 5] <= bit]
        single = (now[:, 1] - now[:, 0] == 1) & (now[:, 3] - now[:, 2] == 1)
        done = now[single & (now[:, 6] == 0)]
        if len(done):
            x = v[done[:, 0]] ^ v[done[:, 2]]
            ok = np.bitwise_count(x) <= budget
            found.append(done[ok][:, [0, 2]])
        now = now[~single]
        if not len(now) and not len(later):
            return np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
        zeros = np.concatenate([[0], np.cumsum(((v >> np.uint64(BITS - 1 - bit)) & np.uint64(1)) == 0)])
        cut_a = now[:, 0] + zeros[now[:, 1]] - zeros[now[:, 0]]
        cut_b = now[:, 2] + zeros[now[:, 3]] - zeros[now[:, 2]]
        own = now[:, 6] == 1

        def child(alo, ahi, blo, bhi, more, mine, keep):
            c = np.column_stack([alo, ahi, blo, bhi, now[:, 4] + more, now[:, 5], mine])
            return c[keep & (ahi > alo) & (bhi > blo) & (c[:, 4] <= budget)]

        yes, every = np.ones(len(now), dtype=np.int64), np.ones(len(now), dtype=bool)
        state = [later,
                 child(now[:, 0], cut_a, now[:, 2], cut_b, 0, own * yes, every),
                 child(cut_a, now[:, 1], cut_b, now[:, 3], 0, own * yes, every),
                 child(now[:, 0], cut_a, cut_b, now[:, 3], 1, 0 * yes, every),
                 child(cut_a, now[:, 1], now[:, 2], cut_b, 1, 0 * yes, ~own)]
    pairs = np.concatenate(state)
    pairs = pairs[pairs[:, 6] == 0]                # equal values are one entry: ranges of one row
    found.append(pairs[:, [0, 2]])
    return np.concatenate(found)


def _join_tasks(budget: int):
    """mapInArrow function: node pairs (rows sorted by node pair) -> links."""
    def solve(t: pd.DataFrame) -> pa.RecordBatch:
        key = t[["part", "depth", "a", "b"]].to_numpy()
        new = np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])
        group, first = np.cumsum(new) - 1, t[new]
        v, depth = t.v.to_numpy().view(np.uint64), t.depth.to_numpy()
        shift = (BITS - depth).astype(np.uint64)
        side = (v >> shift) == t.a.to_numpy().view(np.uint64)
        order = np.lexsort((v, ~side, group))
        fd = np.bitwise_count(first.a.to_numpy().view(np.uint64) ^ first.b.to_numpy().view(np.uint64))
        ij = trie_pairs(group[order], side[order], v[order],
                        (first.a.to_numpy() == first.b.to_numpy()).astype(np.int64),
                        first.depth.to_numpy().astype(np.int64), fd.astype(np.int64), budget)
        fp = t.fp.to_numpy()[order]
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[ij[:, 0]]), pa.array(fp[ij[:, 1]])], names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None                        # the last node pair may go on in the next batch
        for b in batches:
            t = b.to_pandas()
            if not len(t):
                continue
            t = t if rest is None else pd.concat([rest, t], ignore_index=True)
            last = t.iloc[-1]
            tail = ((t.part == last.part) & (t.depth == last.depth) & (t.a == last.a)
                    & (t.b == last.b)).to_numpy()
            rest = t[tail]
            if not tail.all():
                yield solve(t[~tail])
        if rest is not None and len(rest):
            yield solve(rest)
    return run


# ------------------------------------------------------ trie, upper levels

def _right(c: Column, n) -> Column:
    """Unsigned shift to the right by 0..64 places."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.when(n >= BITS, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftrightunsigned", c, n.cast("int")))


def _rotated(fp: Column, by: int) -> Column:
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(_right(fp, BITS - by))


def links(fps: DataFrame, budget: int, node_rows: int = 4096) -> DataFrame:
    """(x, y): distinct fingerprints of column ``fp`` within ``budget`` bits of each other."""
    n_parts = budget + 1
    edges = [round(i * BITS / n_parts) for i in range(n_parts + 1)]
    parts = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(edges[i + 1] - edges[i]).alias("depth"),
                               _rotated(F.col("fp"), edges[i]).alias("v")) for i in range(n_parts)])
    nodes = fps.select("fp", F.inline(parts))
    nodes = nodes.withColumn("a", _right(F.col("v"), BITS - F.col("depth")))
    nodes = nodes.withColumn("b", F.col("a"))
    key = ["part", "depth", "a", "b"]
    ready = []
    while True:
        nodes = stored(nodes, "simhash-nodes")
        size = nodes.groupBy(*key).agg(
            F.count("*").alias("n"),
            F.count_if(_right(F.col("v"), BITS - F.col("depth")) == F.col("a")).alias("n_a"))
        size = size.where("n > 1 and (a = b or (n_a > 0 and n_a < n))")   # the rest has no pair
        large = stored(size.withColumn("large", (F.col("n") > node_rows) & (F.col("depth") < BITS)),
                       "simhash-sizes")
        kept = nodes.join(large.select(*key, "large"), key)
        ready.append(kept.where("not large").drop("large"))
        if large.where("large").isEmpty():
            break
        nodes = _descend(kept.where("large").drop("large"), budget)
    both = ready[0]
    for more in ready[1:]:
        both = both.unionByName(more)
    dealt = both.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(_join_tasks(budget), "x bigint, y bigint").distinct()


def _descend(nodes: DataFrame, budget: int) -> DataFrame:
    """Each node pair replaced by its pairs of nodes ``STEP`` levels lower within the budget."""
    step = F.least(F.lit(STEP), F.lit(BITS) - F.col("depth"))
    own = _right(F.col("v"), BITS - F.col("depth") - step).bitwiseAND(F.shiftleft(F.lit(1).cast("long"), STEP) - 1)
    # with fewer than STEP levels left the mask must be narrower
    own = own.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), step) - 1)
    flips = F.array(*[F.lit(m).cast("long") for m in range(1 << STEP) if bin(m).count("1") <= budget])
    used = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    side_a = _right(F.col("v"), BITS - F.col("depth")) == F.col("a")
    down = nodes.select("fp", "part", "v", "depth", "a", "b", step.alias("step"), own.alias("own"),
                        used.alias("used"), side_a.alias("side_a"), F.explode(flips).alias("flip"))
    down = down.where((F.col("flip") < F.call_function("shiftleft", F.lit(1), F.col("step")))
                      & (F.bit_count("flip") + F.col("used") <= budget))
    other = F.col("own").bitwiseXOR(F.col("flip"))
    up = lambda c: F.call_function("shiftleft", F.col(c), F.col("step"))
    same = F.col("a") == F.col("b")
    new_a = F.when(same, F.least("own", other)).when(F.col("side_a"), F.col("own")).otherwise(other)
    new_b = F.when(same, F.greatest("own", other)).when(F.col("side_a"), other).otherwise(F.col("own"))
    return down.select("fp", "part", (F.col("depth") + F.col("step")).alias("depth"), "v",
                       up("a").bitwiseOR(new_a).alias("a"), up("b").bitwiseOR(new_b).alias("b"))


# ------------------------------------------------------------- components

def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over the edges (x, y), for each linked node.

    Every turn each node takes the least label among its neighbours' and its
    own, and hands it to the node it pointed to; then labels jump to their
    label's label.  The number of turns grows with the logarithm of a chain.
    """
    both = stored(edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))),
                  "components-edges")
    label = stored(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("root")),
                   "components-labels")
    while True:
        seen = (both.join(label.withColumnsRenamed({"node": "y", "root": "there"}), "y")
                .groupBy(F.col("x").alias("node")).agg(F.min("there").alias("least")))
        own = label.join(seen, "node").withColumn("least", F.least("least", "root"))
        hooked = (own.select("node", F.col("least").alias("root"))
                  .unionByName(own.select(F.col("root").alias("node"), F.col("least").alias("root")))
                  .groupBy("node").agg(F.min("root").alias("root")))
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = stored(hooked.join(up, "root").select("node", F.least("above", "root").alias("root")),
                        "components-labels")
        moved = jumped.join(label.withColumnRenamed("root", "before"), "node").where("root <> before").isEmpty()
        label = jumped
        if moved:
            return label


# ------------------------------------------------------------- the operator

def classes(docs: DataFrame, shingle: int = 3, budget: int = 2, node_rows: int = 4096) -> DataFrame:
    """doc_id, row_key, fp, root (a fingerprint of the class), component_id of every row."""
    rows = stored(fingerprints(docs, shingle), "simhash-fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")),
                 "simhash-distinct")
    found = components(fps, links(fps.select("fp"), budget, node_rows))
    rooted = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_fp = rooted.join(least, "root").select("fp", "root", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "row_key", "fp", "root", "component_id")


def document_classes(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return classes(docs, shingle, budget).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """One row of each class: that of its smallest doc_id (a null doc_id last)."""
    found = classes(docs, shingle, budget)
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("least"))
    kept = kept.select(F.col("least.row_key").alias("_row_key"))
    keyed = packed(docs, _row_key=row_hash(docs))
    return keyed.join(kept, "_row_key", "left_semi").dropDuplicates(["_row_key"]).select("_row.*")
