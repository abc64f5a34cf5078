"""Exact removal of repeated byte strings by prefix-free parsing.

A byte is removed if a string of ``length`` bytes that covers it also starts
earlier in the corpus (smaller doc_id, or the same document and an earlier
start).  Strings never cross documents and are judged on the input.

1. **Parse.**  A rolling hash over ``GRAM`` bytes sets triggers: every window
   of ``length`` bytes has as its trigger the leftmost least hash inside it,
   so equal windows have the same trigger at the same offset, gaps between
   triggers are bounded, and no trigger depends on what lies outside.
2. **Counts.**  The triggers are counted over the corpus.  A window can only
   repeat if its trigger does, so triggers seen once drop out with all their
   windows; whole documents are counted in the same pass, and later copies of
   a document are settled there.
3. **Phrases.**  For each repeated trigger the stretches of text that hold its
   windows are brought together in corpus order (doc_id, scan position, start)
   and parsed at the trigger: the phrase up to its end goes to a dictionary,
   the text from its start on is the parse's suffix, at most ``length`` bytes
   of which can matter.
4. **Corpus order.**  A suffix of the corpus is a dictionary suffix that ends
   in the trigger, followed by a parse suffix.  ``dictionary_suffixes`` orders
   the first, ``parse_suffixes`` the second (with the common prefixes of
   neighbours), and ``repeated_windows`` merges both into the order of the
   stretches' suffixes: neighbours that share ``length`` bytes form a class,
   of which all but the first in the corpus are repeated.  No dictionary
   suffix is a proper prefix of another (the trigger ends each and occurs in
   it once), so only suffixes of one length are ever compared, and the
   dictionary's array has a segment per length.  Equal windows share a
   trigger, so the order is only needed within triggers.
5. The repeated windows of a document are merged into runs and cut out.

Skew: scan tasks drop a stretch that equals an earlier one of the same batch
(its windows are settled), so a phrase, passage or document that is very
common sends a few rows per task.  A trigger with more than ``hot`` occurrences
is dealt by window instead, since its stretches may differ in every document:
its windows are told by 128-bit digests, without an order.  Documents travel
with their scan partition's number, one partition to a task, never by trigger;
what a task must know of the counts comes along the same way.

Bytes are compared, in the arrays and within a scan batch; only whole documents
and single windows of hot triggers are told by 128-bit digests.  Defined results: null and empty texts keep nothing; texts
under ``length`` bytes are kept; rows that repeat a doc_id are taken in scan
order; a null doc_id comes last; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tidewater.llm.common import is_scan, stored

LENGTH, GRAM, HOT = 100, 30, 2000
CHUNK_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


# ----------------------------------------------------------- rolling hashes

def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to n."""
    if len(_POWERS[0]) <= n:
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(2 * n + 1, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


class Rolling:
    """Polynomial hashes of all substrings of some bytes."""

    def __init__(self, flat: np.ndarray):
        up, self.down = _powers(len(flat))
        self.sums = np.zeros(len(flat) + 1, dtype=np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[:len(flat)], out=self.sums[1:])

    def __call__(self, start: np.ndarray | slice, length: int) -> np.ndarray:
        """Mixed hash of ``length`` bytes at each start."""
        if isinstance(start, slice):
            h = (self.sums[length:][start] - self.sums[start]) * self.down[start]
        else:
            h = (self.sums[start + length] - self.sums[start]) * self.down[start]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h


def chunks(rows: list[tuple], limit: int = CHUNK_BYTES) -> Iterator[list[tuple]]:
    """Runs of rows whose last fields (bytes) add up to about ``limit``."""
    part, size = [], 0
    for row in rows:
        if part and size + len(row[-1]) > limit:
            yield part
            part, size = [], 0
        part.append(row)
        size += len(row[-1])
    if part:
        yield part


class Parse:
    """Triggers of some documents laid end to end.

    ``doc``, ``first``, ``last``, ``trigger``, ``phrase``: for each trigger its
    document, the first and last start of the windows that have it, its own
    start and its hash.
    """

    def __init__(self, bodies: list[bytes], length: int):
        sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies))
        self.at = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        self.flat, self.rolling = flat, Rolling(flat)
        n = len(flat) - GRAM + 1
        if n <= 0:
            self.doc = self.first = self.last = self.trigger = np.zeros(0, dtype=np.int64)
            self.phrase = np.zeros(0, dtype=np.uint64)
            return
        hashes = self.rolling(slice(0, n), GRAM)
        # least hash, then leftmost, over length - GRAM + 1 places, by doubling
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        width, need = 1, min(length - GRAM + 1, n)
        while 2 * width <= need:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < need:
            least = np.minimum(least[:len(least) - (need - width)], least[need - width:])
        windows = np.maximum(sizes - length + 1, 0)
        total = int(windows.sum())
        doc = np.repeat(np.arange(len(bodies)), windows)
        start = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows) + self.at[doc]
        trigger = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(total, dtype=bool)
        new[1:] = (trigger[1:] != trigger[:-1]) | (doc[1:] != doc[:-1])
        ends = np.append(np.flatnonzero(new)[1:], total) - 1 if total else np.zeros(0, dtype=np.int64)
        self.doc, self.first, self.last = doc[new], start[new], start[ends]
        self.trigger = trigger[new]
        self.phrase = hashes[self.trigger]


def digest(body: bytes) -> tuple[int, int]:
    """A 128-bit digest as two signed numbers."""
    return struct.unpack("<qq", hashlib.blake2b(body, digest_size=16).digest())


def equal_strings(flat: np.ndarray, one: np.ndarray, other: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` bytes at each start of ``one`` and ``other`` are equal, compared byte by byte."""
    same = np.ones(len(one), dtype=bool)
    step = max(1, (8 << 20) // size)
    inside = np.arange(size)
    for k in range(0, len(one), step):
        a, b = one[k:k + step, None] + inside, other[k:k + step, None] + inside
        same[k:k + step] = (flat[a] == flat[b]).all(axis=1)
    return same


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


# ------------------------------------------------------------------ counts

def counts(rows: DataFrame, length: int) -> DataFrame:
    """What each scan partition must know: p, kind, h, n and, for documents, the first copy (d, a).

    kind 0: a trigger with n > 1 occurrences; kind 1: a document text with more
    than one row, whose digest is h and n.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, d, a, bodies = (c.to_pylist() for c in b.columns)
            whole: dict[tuple, list] = {}
            for part, i, j, body in zip(p, d, a, bodies):
                if len(body) >= length:
                    entry = whole.setdefault((part, *digest(body)), [0, (i is None, i or 0, j)])
                    entry[0] += 1
                    entry[1] = min(entry[1], (i is None, i or 0, j))
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in whole], pa.int32()), pa.array([1] * len(whole), pa.int32()),
                pa.array([k[1] for k in whole], pa.int64()), pa.array([v[0] for v in whole.values()], pa.int64()),
                pa.array([None if v[1][0] else v[1][1] for v in whole.values()], pa.int64()),
                pa.array([v[1][2] for v in whole.values()], pa.int64()),
                pa.array([k[2] for k in whole], pa.int64())], names=["p", "kind", "h", "n", "d", "a", "h2"])
            for part in chunks(list(zip(p, bodies))):
                parsed = Parse([x[1] for x in part], length)
                h, n = np.unique(parsed.phrase, return_counts=True)
                none = pa.nulls(len(h), pa.int64())
                yield pa.RecordBatch.from_arrays([            # a batch has one scan partition
                    pa.array(np.full(len(h), part[0][0], dtype=np.int32)),
                    pa.array(np.zeros(len(h), dtype=np.int32)), pa.array(_signed(h)), pa.array(n.astype(np.int64)),
                    none, none, none], names=["p", "kind", "h", "n", "d", "a", "h2"])

    found = rows.select("p", "d", "a", "body").mapInArrow(
        run, "p int, kind int, h bigint, n bigint, d bigint, a bigint, h2 bigint")
    same = Window.partitionBy("kind", "h", "h2")
    first = F.min(F.struct(F.col("d").isNull().alias("no"), "d", "a")).over(same)
    return (found.withColumns({"total": F.sum("n").over(same), "one": first}).where("total > 1")
            .select("p", "kind", "h", F.coalesce("h2", "total").alias("n"), "one.d", "one.a"))


# ------------------------------------------------------------ corpus order

def _runs(a: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, dtype=np.int64)) for x in (a, start, end)],
                                      names=["a", "start", "end"])


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Overlapping or touching (row, start, end) runs joined; starts and ends rise within a row."""
    if not len(row):
        return row, start, end
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > end[:-1])
    ends = np.append(np.flatnonzero(new)[1:], len(row)) - 1
    return row[new], start[new], end[ends]


def stretches(routed: DataFrame, length: int, hot: int) -> DataFrame:
    """Of the documents of each scan partition: stretches to compare, and runs settled already.

    ``key`` is null in a settled run (a, start, end).  Else the windows of
    ``body``, the first at ``start`` of row ``a``, have the trigger at ``end``,
    whose hash is ``key``; without a body it is the one window whose digest is
    ``key`` and ``end``.
    """
    names = ["key", "d", "a", "start", "end", "body"]

    def out(key, d, a, start, end, body) -> pa.RecordBatch:
        kinds = (pa.int64(),) * 5 + (pa.binary(),)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((key, d, a, start, end, body), kinds)],
                                          names=names)

    def settle(rows: list[tuple], phrases, totals) -> Iterator[pa.RecordBatch]:
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))      # corpus order
        for part in chunks(rows):
            parsed = Parse([r[-1] for r in part], length)
            place = np.searchsorted(phrases, parsed.phrase)
            place[place == len(phrases)] = 0
            known = phrases[place] == parsed.phrase if len(phrases) else np.zeros(len(place), dtype=bool)
            doc, first, last = parsed.doc[known], parsed.first[known], parsed.last[known]
            phrase, common = parsed.phrase[known], totals[place[known]] > hot
            at, a = parsed.at, np.array([r[1] for r in part])
            d = [r[0] for r in part]
            # a stretch equal to an earlier one of this chunk is settled
            sums = parsed.rolling.sums
            size = last + length - first
            whole = (sums[first + size] - sums[first]) * parsed.rolling.down[first]
            whole = whole ^ (size.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
            view = memoryview(parsed.flat)
            _, one, which = np.unique(whole, return_index=True, return_inverse=True)
            one = one[which]
            later = one != np.arange(len(whole))
            for i in np.flatnonzero(later):
                j = one[i]
                later[i] = view[first[i]:last[i] + length] == view[first[j]:last[j] + length]
            row, begin, end = _merged(doc[later], first[later], last[later] + length)
            yield out([None] * len(row), [None] * len(row), a[row], begin - at[row], end - at[row], [None] * len(row))
            todo = ~later & ~common
            yield out(_signed(phrase[todo]), [d[i] for i in doc[todo]], a[doc[todo]], (first - at[doc])[todo],
                      (parsed.trigger[known] - at[doc])[todo],
                      [bytes(view[i:j]) for i, j in zip(first[todo], (last + length)[todo])])
            todo = ~later & common                                     # dealt by window
            if todo.any():
                n = (last - first)[todo] + 1
                owner = np.repeat(doc[todo], n)
                start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[todo], n)
                h = parsed.rolling(start, length)
                _, one, which = np.unique(h, return_index=True, return_inverse=True)
                one = one[which]
                again = one != np.arange(len(h))
                again[again] = equal_strings(parsed.flat, start[again], start[one[again]], length)
                row, begin, end = _merged(owner[again], start[again], start[again] + length)
                yield out([None] * len(row), [None] * len(row), a[row], begin - at[row], end - at[row],
                          [None] * len(row))
                own, begin = owner[~again], start[~again]
                told = [digest(view[i:i + length]) for i in begin]
                yield out([t[0] for t in told], [d[i] for i in own], a[own], begin - at[own],
                          [t[1] for t in told], [None] * len(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, words, copies, table = None, [], {}, None
        for part, o, a, h, n, body in _fields(batches):
            if part != p:
                p, words, copies, table = part, [], {}, None
            if o == 0:
                words.append((h, n))
            elif o == 1:
                copies[h, n] = a
            else:
                if table is None:
                    known = np.array(words, dtype=np.int64).reshape(-1, 2)
                    phrases, where = np.unique(known[:, 0].view(np.uint64), return_index=True)
                    table, words = (phrases, known[where, 1]), []
                rows, whole = [], []
                for d, i, text in _unpacked(body):
                    if len(text) >= length:
                        if copies.get(digest(text), i) != i:    # a later copy of a document
                            whole.append((i, len(text)))
                        else:
                            rows.append((d, i, text))
                none = [None] * len(whole)
                yield out(none, none, [w[0] for w in whole], [0] * len(whole), [w[1] for w in whole], none)
                if rows:
                    yield from settle(rows, *table)

    return routed.mapInArrow(run, "key bigint, d bigint, a bigint, start bigint, end bigint, body binary")


def dictionary_suffixes(phrases: list[bytes]) -> np.ndarray:
    """Ranks of the dictionary's suffixes: row i, column k for the last ``GRAM + k`` bytes of phrase i.

    All phrases end in a trigger of ``GRAM`` bytes.  The suffixes of one more
    byte are ordered by that byte and the rank of the rest, so each length's
    order is induced from the one before.  Ranks rise in order within a length
    and differ between lengths; -1 where a phrase is shorter.
    """
    sizes = np.fromiter(map(len, phrases), dtype=np.int64, count=len(phrases))
    width = int(sizes.max())
    flat = np.frombuffer(b"".join(x.rjust(width, b"\0") for x in phrases), dtype=np.uint8).reshape(-1, width)
    triggers = {t: i for i, t in enumerate(sorted({x[-GRAM:] for x in phrases}))}
    ranks = np.full((len(phrases), width - GRAM + 1), -1, dtype=np.int64)
    rank = np.fromiter((triggers[x[-GRAM:]] for x in phrases), dtype=np.int64, count=len(phrases))
    ranks[:, 0] = rank
    used = len(triggers)
    alive = np.arange(len(phrases))
    for k in range(1, width - GRAM + 1):
        keep = sizes[alive] >= GRAM + k
        alive, rank = alive[keep], rank[keep]
        order, rank = np.unique(flat[alive, width - GRAM - k].astype(np.int64) * len(phrases) + rank,
                                return_inverse=True)
        ranks[alive, k] = used + rank
        used += len(order)
    return ranks


def parse_suffixes(rest: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each parse suffix, bytes that each distinct one shares with the one before it in order)."""
    order = sorted(set(rest))
    place = {x: i for i, x in enumerate(order)}
    width = max(map(len, order))
    sizes = np.fromiter(map(len, order), dtype=np.int64, count=len(order))
    flat = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in order), dtype=np.uint8).reshape(-1, width)
    shared = np.zeros(len(order), dtype=np.int64)
    differ = np.concatenate([flat[1:] != flat[:-1], np.ones((len(order) - 1, 1), dtype=bool)], axis=1)
    shared[1:] = np.minimum(differ.argmax(axis=1), np.minimum(sizes[1:], sizes[:-1]))
    return np.fromiter((place[x] for x in rest), dtype=np.int64, count=len(rest)), shared


def _least(shared: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of shared[low + 1 .. high] for each pair low < high."""
    levels = [shared]
    while 2 << (len(levels) - 1) <= len(shared):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    level = np.frexp((high - low).astype(np.float64))[1] - 1          # floor(log2)
    out = np.empty(len(low), dtype=np.int64)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(levels[k][low[at] + 1], levels[k][high[at] + 1 - (1 << int(k))])
    return out


def repeated_windows(bodies: list[bytes], triggers: list[int], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, start in it) of the windows that also start in an earlier stretch, in rising order.

    The stretches of a trigger come in corpus order; its start in each is given.
    """
    words: dict[bytes, int] = {}
    phrase = np.fromiter((words.setdefault(b[:t + GRAM], len(words)) for b, t in zip(bodies, triggers)),
                         dtype=np.int64, count=len(bodies))
    ranks = dictionary_suffixes(list(words))
    rest, shared = parse_suffixes([b[t:] for b, t in zip(bodies, triggers)])
    n = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies)) - length + 1
    owner = np.repeat(np.arange(len(bodies)), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    left = np.asarray(triggers, dtype=np.int64)[owner] - inside       # bytes before the trigger
    suffix, follow = ranks[phrase[owner], left], rest[owner]
    order = np.argsort(suffix * len(shared) + follow, kind="stable")
    suffix, follow, left = suffix[order], follow[order], left[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = suffix[1:] != suffix[:-1]
    near = np.flatnonzero(~new & (np.append(-1, follow[:-1]) != follow))   # one dictionary suffix, two that follow
    new[near] = _least(shared, follow[near - 1], follow[near]) < length - left[near]
    first = np.minimum.reduceat(order, np.flatnonzero(new))
    again = np.ones(len(order), dtype=bool)
    again[first] = False
    return owner[again], inside[again]


def compare(found: DataFrame, length: int) -> DataFrame:
    """Runs (a, start, end): those settled, and the windows that are not the first of their class."""
    def resolve(rows: list[tuple]) -> pa.RecordBatch:
        owner, inside = repeated_windows([r[-1] for r in rows], [r[3] - r[2] for r in rows], length)
        begin = inside + np.array([r[2] for r in rows])[owner]
        row, begin, end = _merged(owner, begin, begin + length)
        return _runs(np.array([r[1] for r in rows])[row], begin, end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last, single = [], 0, None, None
        for b in batches:
            ones = []
            for kind, key, a, start, end, body in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 2:
                    ones.append((a, start, end))
                    continue
                if body is None:                       # one window, told by its digest
                    if single == (key, end):
                        ones.append((a, start, start + length))
                    single = (key, end)
                    continue
                if key != last and size >= CHUNK_BYTES:        # triggers are never parted
                    yield resolve(rows)
                    rows, size = [], 0
                last = key
                rows.append((key, a, start, end, body))
                size += len(body)
            if ones:
                yield _runs(*zip(*ones))
        if rows:
            yield resolve(rows)

    kind = F.when(F.col("key").isNull(), 2).when(F.col("body").isNull(), 1).otherwise(0)
    todo = found.withColumns({"kind": kind, "key": F.coalesce("key", "a")})
    dealt = todo.repartition("kind", "key").sortWithinPartitions(
        "kind", "key", F.when(F.col("kind") == 1, F.col("end")), F.col("d").asc_nulls_last(), "a", "start")
    return dealt.select("kind", "key", "a", "start", "end", "body").mapInArrow(
        run, "a bigint, start bigint, end bigint")


# ----------------------------------------------------------------- cutting

def _cut(body: bytes, runs: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, bytes kept)."""
    kept, at, removed, spans = [], 0, 0, 0
    for start, end in sorted(runs):
        if start > at or not spans:
            spans += 1
            kept.append(body[at:start])
            removed += end - start
            at = end
        elif end > at:
            removed += end - at
            at = end
    kept.append(body[at:])
    return removed, spans, b"".join(kept)


def _packed(rows: DataFrame) -> DataFrame:
    """(p, blob): the documents of a scan partition in compressed chunks, for the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, d, a, bodies = (c.to_pylist() for c in b.columns)
            for part in chunks(list(zip(p, d, a, bodies))):
                blob = zstandard.compress(pickle.dumps([r[1:] for r in part], protocol=5), 3)
                yield pa.RecordBatch.from_arrays([pa.array([part[0][0]], pa.int32()), pa.array([blob], pa.binary())],
                                                 names=["p", "body"])

    return rows.select("p", "d", "a", "body").mapInArrow(run, "p int, body binary")


def _unpacked(blob: bytes) -> list[tuple]:
    """(doc_id, row, text) of a chunk that ``_packed`` made in this same query."""
    return pickle.loads(zstandard.decompress(blob))


def _routed(docs: DataFrame, notes: DataFrame, n: int) -> DataFrame:
    """Documents and notes of each of the ``n`` scan partitions in a task, the notes (o < 2) first."""
    none = {c: F.lit(None).cast("long") for c in ("a", "h", "n")}
    both = notes.unionByName(_packed(docs).withColumns({"o": F.lit(2), **none}))
    return both.select("p", "o", "a", "h", "n", "body").repartitionById(n, "p").sortWithinPartitions("p", "o")


def _fields(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of ``_routed``, one after the other; blobs are not held longer than needed."""
    for b in batches:
        small = [c.to_pylist() for c in b.columns[:-1]]
        for i, row in enumerate(zip(*small)):
            yield (*row, b.column(5)[i].as_py())


def cut_documents(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every row."""
    if length < GRAM + 1:
        raise ValueError(f"length must be at least {GRAM + 1}")
    if not is_scan(docs):                      # the steps below must see the same scan partitions
        docs = stored(docs.select("doc_id", "text"), "suffix-input")
    # a row's number holds its scan partition in its upper bits
    rows = docs.select(F.col("doc_id").cast("long").alias("d"), F.monotonically_increasing_id().alias("a"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    rows = rows.withColumn("p", F.shiftright("a", 33).cast("int"))
    n = max(rows.rdd.getNumPartitions(), 1)
    none = F.lit(None).cast("binary").alias("body")
    notes = counts(rows, length).select("p", F.col("kind").alias("o"), "a", "h", "n", none)
    runs = compare(stretches(_routed(rows, notes, n), length, hot), length)
    runs = runs.select(F.shiftright("a", 33).cast("int").alias("p"), F.lit(0).alias("o"), "a",
                       F.col("start").alias("h"), F.col("end").alias("n"), none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, by_row = None, {}
        kinds = (pa.int64(),) * 4 + (pa.string(), pa.binary())
        for part, o, a, h, n, body in _fields(batches):
            if part != p:
                p, by_row = part, {}
            if o == 0:
                by_row.setdefault(a, []).append((h, n))
                continue
            rows_out = []
            for d, i, text in _unpacked(body):
                removed, spans, kept = _cut(text, by_row.pop(i, []))
                rows_out.append((d, len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows_out), kinds)], names=[
                "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return _routed(rows, runs, n).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


def document_cuts(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    return cut_documents(docs, length, hot).drop("kept")
