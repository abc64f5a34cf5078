"""Conversation prefix trie: every shared beginning of turn sequences, with totals.

A turn is known by two 63-bit hashes of its role and text, so a conversation
is a sequence of numbers.  Sequences are dealt to tasks by range; every task
holds one range (a shard) and builds its part of the trie with numpy:

1. padded turn-id matrices, ``BLOCK`` columns at a time, sorted by a stable
   lexsort from the deepest block up (only sequences that reach a block are
   in its matrix, so one long sequence does not pad the others);
2. a row that differs from the one before it in a column, or in any column to
   the left (the masks are OR-accumulated), starts a new node there;
3. ``reduceat`` over the node starts of a depth sums what the node's rows add.

Nodes on the path of a shard's first or last sequence may go on in the
neighbour shard.  They leave the task as pieces; neighbours' last and first
sequences are compared, and what was counted on both sides of a boundary
(starts, leaves, saved words) is taken back.  Pieces and corrections of a node
add up under the hash of its prefix.  Ties of the ranges are broken by id, so
a sequence that a third of all conversations share spreads over many shards.

Bounds: a task holds the turn numbers (24 bytes a turn) of one range; the
numbers of one conversation are a row.  Equal 126-bit hashes count as equal turns.

Defined results: rows with a null conv_id belong to no conversation; null role
or text counts as empty; turns are ordered null first, ties by their hashes
(repeated rows are turns of their own); a conversation without turns is a
member of the root alone; an empty table gives no nodes; extra columns are
ignored; texts of any length are hashed and counted whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewater.llm.common import stored, streamed_sha256, word_count

BLOCK = 16
PAD = -1                                        # below every turn number
GROUP, HEADS = 20, 4                            # conversations with a common opening; its length is below HEADS
TURN = "struct<turn:bigint,a:bigint,b:bigint,words:bigint>"


# ---- sequences --------------------------------------------------------------------------

def turn_sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and ``turns``, an array of (turn, a, b, words) in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    one = F.struct(F.col("turn").cast("long").alias("turn"),
                   F.shiftrightunsigned(F.xxhash64(role, text), 1).alias("a"),
                   F.shiftrightunsigned(F.xxhash64(F.lit(1), text, role), 1).alias("b"),
                   word_count(F.col("text")).alias("words"))
    slim = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("t"))
    return slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))      # nulls first


def with_shared_openings(sequences: DataFrame) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % 20 in place of its own first
    h, where h = crc32(c) % 4."""
    sequences = stored(sequences, "trie-turns")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = sequences.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    own = F.when(F.size("turns") > h, F.slice(F.col("turns"), h + 1, F.size("turns"))).otherwise(F.array().cast(f"array<{TURN}>"))
    head = F.when(h > 0, F.slice(F.coalesce("head", F.array().cast(f"array<{TURN}>")), 1, F.greatest(h, F.lit(1)))).otherwise(
        F.array().cast(f"array<{TURN}>"))
    return (sequences.withColumn("base", base).join(heads, "base", "left")
            .select("conv_id", F.concat(head, own).alias("turns")))


# ---- one shard ---------------------------------------------------------------------------

class Shard:
    """The trie of one range of sequences, given as flat turn arrays and lengths."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray, words: np.ndarray):
        self.a, self.b, self.words = a, b, words
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        deepest = int(lengths.max()) if len(lengths) else 0
        for block in range((deepest - 1) // BLOCK, -1, -1):
            alive = lengths[order] > block * BLOCK
            these = order[alive]
            columns = self._padded(begin[these], lengths[these], block)
            sort = np.lexsort([m[:, c] for c in range(BLOCK - 1, -1, -1) for m in reversed(columns)])
            order = np.concatenate([order[~alive], these[sort]])
        self.ids, self.lengths, self.begin = ids[order], lengths[order], begin[order]
        self._mark(deepest)

    def _padded(self, begin: np.ndarray, lengths: np.ndarray, block: int) -> list[np.ndarray]:
        at = block * BLOCK + np.arange(BLOCK)
        real = at < lengths[:, None]
        flat = np.where(real, begin[:, None] + at, 0)
        return [np.where(real, values[flat], PAD) for values in (self.a, self.b)]

    def _mark(self, deepest: int) -> None:
        """starts[block]: (rows that reach the block, mask of node starts); ``shared``: leading turns
        that a row has in common with the row before it."""
        n = len(self.ids)
        changed = np.zeros(n, bool)
        changed[:1] = True
        self.starts, self.shared = [], np.zeros(n, np.int64)
        for block in range((deepest - 1) // BLOCK + 1):
            rows = np.flatnonzero(self.lengths > block * BLOCK)
            columns = self._padded(self.begin[rows], self.lengths[rows], block)
            new = np.zeros((len(rows), BLOCK), bool)
            for m in columns:
                new[1:] |= m[1:] != m[:-1]
            follows = np.zeros(len(rows), bool)
            follows[1:] = rows[1:] == rows[:-1] + 1
            new[~follows] = True                       # the row before ended above this block
            new[:, 0] |= changed[rows]
            new = np.logical_or.accumulate(new, axis=1)
            changed[rows] = new[:, -1]
            real = block * BLOCK + np.arange(BLOCK) < self.lengths[rows][:, None]
            self.shared[rows] += (real & ~new).sum(1)
            self.starts.append((rows, new))

    def levels(self) -> Iterator[dict]:
        """The nodes of each depth from 0, as arrays."""
        n = len(self.ids)
        # a node without children is counted at its last row: the next row does not go on from it
        last = np.ones(n, bool)
        last[:-1] = self.shared[1:] < self.lengths[:-1]
        leaf = last.astype(np.int64)
        saved = np.zeros(n, np.int64)                  # words of a row's turns, from this depth on, that start no node
        for block, (rows, new) in enumerate(self.starts):
            at = block * BLOCK + np.arange(BLOCK)
            real = (at < self.lengths[rows][:, None]) & ~new
            flat = np.where(real, self.begin[rows][:, None] + at, 0)
            saved[rows] += np.where(real, self.words[flat], 0).sum(1)
        node_of = np.full(n, -1)                       # a row's node one level up
        rows, start = np.arange(n), np.zeros(n, bool)
        start[:1] = True
        depth = 0
        while len(rows):
            index = np.flatnonzero(start)
            parent = node_of[rows[index]]
            node_of[rows] = np.cumsum(start) - 1
            ending = self.lengths[rows] == depth
            below = rows[~ending]
            block, column = divmod(depth, BLOCK)
            child = np.zeros(len(rows), bool)
            if len(below):
                reach, new = self.starts[block]
                child[~ending] = new[np.searchsorted(reach, below), column]
            yield {"depth": depth, "first": rows[index], "parent": parent,
                   "conv_id": np.minimum.reduceat(self.ids[rows], index),
                   "n_convs": np.diff(np.append(index, len(rows))),
                   "n_children": np.add.reduceat(child.astype(np.int64), index),
                   "n_leaves": np.add.reduceat(leaf[rows], index),
                   "saved": np.add.reduceat(saved[rows], index),
                   "ends": np.add.reduceat(ending.astype(np.int64), index),
                   "is_first": rows[0] == 0, "is_last": rows[-1] == n - 1}
            if depth:                                  # the words of this turn do not count below
                going = rows[~start & ~ending]
                saved[going] -= self.words[self.begin[going] + depth - 1]
            rows, start, depth = below, child[~ending], depth + 1

    def path(self, row: int, depth: int | None = None) -> np.ndarray:
        """Turn numbers of a row, a and b in turns."""
        stop = self.lengths[row] if depth is None else depth
        at = slice(self.begin[row], self.begin[row] + stop)
        return np.stack([self.a[at], self.b[at]], 1).reshape(-1)


def prefix_keys(path: np.ndarray) -> Iterator[str]:
    """A key of each prefix of a path, from the empty one on."""
    state = hashlib.sha256()
    yield state.hexdigest()
    for i in range(0, len(path), 2):
        state.update(path[i:i + 2].astype("<i8").tobytes())
        yield state.copy().hexdigest()


NODE = ("shard int, edge int, key string, depth bigint, conv_id bigint, parent_conv_id bigint, parent_edge int, "
        "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, "
        "first array<bigint>, last array<bigint>, first_words array<bigint>")
_ARROW = pa.schema([("shard", pa.int32()), ("edge", pa.int32()), ("key", pa.string()), ("depth", pa.int64()),
                    ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("parent_edge", pa.int32()),
                    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                    ("saved_tokens", pa.int64()), ("ends", pa.string()), ("first", pa.list_(pa.int64())),
                    ("last", pa.list_(pa.int64())), ("first_words", pa.list_(pa.int64()))])
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _node_rows(shard: Shard, number: int) -> Iterator[pa.RecordBatch]:
    """Final rows of the inner nodes, pieces of those on the first or last row's path (``edge`` numbers
    them; ``ends`` is then a list of ids, else its SHA-256), and one row with both paths."""
    n = len(shard.ids)
    first, last = shard.path(0), shard.path(n - 1)
    keys = prefix_keys(first), prefix_keys(last)
    edges = 0
    above: tuple[np.ndarray, np.ndarray] | None = None          # conv_id and edge of the nodes one level up
    held: list[pa.RecordBatch] = []
    size = 0
    for level in shard.levels():
        count = len(level["first"])
        edge, key = np.full(count, -1), [None] * count
        if level["is_first"]:
            key[0], edge[0], edges = next(keys[0]), edges, edges + 1
        if level["is_last"]:
            k = next(keys[1])
            if edge[-1] < 0:
                key[-1], edge[-1], edges = k, edges, edges + 1
        ends = []
        for at, many, e in zip(level["first"].tolist(), level["ends"].tolist(), edge.tolist()):
            listed = ",".join(map(str, shard.ids[at:at + many].tolist())) if many else ""
            ends.append(listed if e >= 0 else (hashlib.sha256(listed.encode()).hexdigest() if many else _NO_ENDS))
        if above is None:
            parent_id, parent_edge = np.full(count, 0), np.full(count, -1)
            no_parent = np.ones(count, bool)
        else:
            parent_id, parent_edge = above[0][level["parent"]], above[1][level["parent"]]
            no_parent = parent_edge >= 0                         # known only when the pieces are put together
        none = pa.nulls(count, pa.list_(pa.int64()))
        held.append(pa.RecordBatch.from_arrays([
            pa.array(np.full(count, number), pa.int32()), pa.array(edge, pa.int32()), pa.array(key, pa.string()),
            pa.array(np.full(count, level["depth"]), pa.int64()), pa.array(level["conv_id"], pa.int64()),
            pa.array(parent_id, pa.int64(), mask=no_parent), pa.array(parent_edge, pa.int32()),
            *[pa.array(level[c], pa.int64()) for c in ("n_convs", "n_children", "n_leaves", "saved")],
            pa.array(ends, pa.string()), none, none, none], schema=_ARROW))
        above = level["conv_id"], edge
        size += count
        if size >= 20_000 or len(held) >= 500:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    words = shard.words[shard.begin[0]:shard.begin[0] + shard.lengths[0]]
    held.append(pa.RecordBatch.from_pylist([{"shard": number, "edge": -2, "first": first.tolist(), "last": last.tolist(),
                                             "first_words": words.tolist()}], schema=_ARROW))
    yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    ids, lengths, a, b, words = [], [], [], [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids.append(batch.column("conv_id").to_numpy())
        turns = batch.column("turns")
        lengths.append(np.diff(turns.offsets.to_numpy()).astype(np.int64))
        flat = turns.flatten()
        for out, name in ((a, "a"), (b, "b"), (words, "words")):
            out.append(flat.field(name).to_numpy())
    if ids:
        shard = Shard(*[np.concatenate(x) for x in (ids, lengths, a, b, words)])
        yield from _node_rows(shard, TaskContext.get().partitionId())


# ---- boundaries --------------------------------------------------------------------------

CORRECTION = ("key string, depth bigint, n_children bigint, n_leaves bigint, saved_tokens bigint")


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a shard's last and the next one's first sequence were both counted for."""
    schema = pa.schema([("key", pa.string()), ("depth", pa.int64()), ("n_children", pa.int64()),
                        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])
    for batch in batches:
        for row in batch.to_pylist():
            last, after = (np.array(row[c], np.int64) for c in ("last", "after"))
            m = min(len(last), len(after))
            differ = np.flatnonzero(last[:m] != after[:m])
            common = (int(differ[0]) if len(differ) else m) // 2
            words = np.array(row["after_words"][:common], np.int64)
            saved = np.append(np.cumsum(words[::-1])[::-1], 0)
            # the first row's own turn is no start: its node at depth d saves the turns from d - 1 on
            saved = np.concatenate([[saved[0]], saved[:common]])
            children = -(np.arange(common + 1) < common).astype(np.int64)
            leaves = np.full(common + 1, -1 if 2 * common == len(last) else 0)
            keys = list(prefix_keys(last[:2 * common]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(np.arange(common + 1), pa.int64()),
                                              pa.array(children), pa.array(leaves, pa.int64()), pa.array(saved)],
                                             schema=schema)


def _joined_pieces(nodes: DataFrame) -> DataFrame:
    """Every node that touches a boundary, once: its key, totals and ends_sha256."""
    pieces = nodes.where("edge >= 0")
    in_order = Window.orderBy("shard")                           # one row per shard
    bounds = nodes.where("edge = -2").select("last", F.lead("first").over(in_order).alias("after"),
                                             F.lead("first_words").over(in_order).alias("after_words"))
    fixes = bounds.where("after is not null").mapInArrow(_corrections, CORRECTION)
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    parts = pieces.select("key", "depth", "conv_id", *sums).unionByName(fixes, allowMissingColumns=True)
    total = parts.groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"),
                                              *[F.sum(c).alias(c) for c in sums])
    listed = streamed_sha256(pieces.where("ends != ''"), "key", "shard", "ends", ",")
    return total.join(listed, "key", "left").withColumn("ends_sha256", F.coalesce("sha256", F.lit(_NO_ENDS))).drop("sha256")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """The trie of (conv_id, turns) rows, one row per node.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    order = F.transform("turns", lambda t: F.struct(t["a"], t["b"]))
    dealt = sequences.withColumn("_order", order).repartitionByRange("_order", "conv_id").drop("_order")
    nodes = stored(dealt.mapInArrow(_build, NODE), "trie-nodes")
    whole = stored(_joined_pieces(nodes), "trie-edges")
    # where each shard's edge nodes ended up: their number in the shard -> the whole node
    homes = nodes.where("edge >= 0").select("shard", "edge", "key", "parent_edge").join(
        whole.select("key", F.col("conv_id").alias("home")), "key")
    homes = stored(homes.select("shard", "edge", "key", "parent_edge", "home"), "trie-homes")
    up = homes.select("shard", F.col("edge").alias("parent_edge"), F.col("home").alias("up"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = nodes.where("edge = -1").withColumnRenamed("ends", "ends_sha256")
    known = inner.where("parent_edge < 0")
    asked = inner.where("parent_edge >= 0").drop("parent_conv_id").join(up, ["shard", "parent_edge"]).withColumnRenamed(
        "up", "parent_conv_id")
    lines = homes.join(up, ["shard", "parent_edge"], "left").groupBy("key").agg(F.max("up").alias("parent_conv_id"))
    edge = whole.join(lines, "key")
    return known.select(columns).unionByName(asked.select(columns)).unionByName(edge.select(columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations with shared openings."""
    return prefix_trie(with_shared_openings(turn_sequences(conversations)))
