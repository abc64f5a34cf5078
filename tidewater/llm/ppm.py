"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts of up to ``ORDER`` bytes with the counts
of what follows, learned from the training documents.  A byte is coded in its
longest known context; if it was not seen there, an escape is coded (method C:
the escape's weight is the number of distinct bytes seen) and the next shorter
context is tried, without the bytes already excluded; below order 0 all
remaining bytes are alike.  A text is preceded by NUL bytes and followed by an
end symbol (0xFF, which UTF-8 never has), so the probabilities of all texts
add up to one.

Counting: every task adds up its own strings of context and symbol and its
words, Spark adds the tasks' counts.  Shorter contexts are sums of longer
ones.  The whole trie stays a table.  The contexts that hold at least ``share``
of all training bytes are also broadcast with their pairs: at most 1 / share
of an order on any input, and about the same share of the bytes lies behind
them at every size (should an order have more than ``max_edges`` such pairs,
the share is doubled until they fit).  A context that was broadcast is there
with all its symbols and all its shorter contexts, so a byte behind it is
coded exactly in the scan, where tasks code all bytes of a run of texts
together, order by order.  The other bytes leave the scan as one row per
document and distinct (context, symbol) pair; those pairs are coded by joins
with the tables, so the bound has no effect on any score.

The word-level base score needs the counts of all training words, which have
no bound: the ``max_frequent`` most frequent ones are broadcast and handle
most tokens in the scan; the rest are joined by word, with one row per
document and distinct rare word.

Defined results: null and empty texts are the empty text, scored by its end
alone; without training documents all symbols are alike; repeated rows each
get a row; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import stored

ORDER = 5                                    # context bytes; with the symbol at most 8 bytes
CHUNK_BYTES, FLUSH_WORDS = 512 << 10, 300_000
SLICE_ROWS = 1000
SHARE, MAX_EDGES = 2.0 ** -21, 1 << 21
MAX_FREQUENT, WORD_BYTES = 1 << 17, 64


def fold(doc_id: Column, folds: int = 7) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


# ----------------------------------------------------- contexts of a chunk

def chunks(raws: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Runs of texts of about ``limit`` bytes (a longer text is a run of its own)."""
    part, size = [], 0
    for raw in raws:
        if part and size + len(raw) > limit:
            yield part
            part, size = [], 0
        part.append(raw)
        size += len(raw)
    if part:
        yield part


def grams(part: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(context and symbol of each coded byte as one number, first of each text).

    The number's lowest byte is the symbol, the next one the byte before it, and so on.
    """
    pad = bytes(order)
    flat = np.frombuffer(b"".join(pad + raw + b"\xff" for raw in part), dtype=np.uint8)
    sizes = np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1
    starts = np.cumsum(sizes) - sizes
    n = len(flat) - order
    out = np.zeros(n, dtype=np.uint64)
    for i in range(order + 1):
        out = (out << np.uint64(8)) | flat[i:i + n]
    keep = np.ones(n, dtype=bool)                    # symbols of the padding are not coded
    padded = np.cumsum(sizes + order)[:-1] - order
    for i in range(order):
        keep[padded + i] = False
    return out[keep], starts


def gram_counts(raws: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context, symbol) numbers with their counts."""
    keys, counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    for part in chunks(raws):
        k, n = np.unique(grams(part, order)[0], return_counts=True)
        both, where = np.unique(np.concatenate([keys, k]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([counts, n]), len(both)).astype(np.int64)
        keys = both
    return keys, counts


# ------------------------------------------------------------- the model

class Places:
    """Open-addressing table from 64-bit numbers to their places in an array."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask, self.keys = np.uint64(64 - bits), (1 << bits) - 1, keys
        self.at = np.full(1 << bits, -1, dtype=np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.at[slot] < 0
            self.at[slot[free]] = left[free]         # of several claims on a slot one stays
            lost = self.at[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each number, -1 where it is absent."""
        slot = self._slot(keys)
        out = self.at[slot]
        if not len(self.keys):
            return out
        todo = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            out[todo] = self.at[slot[todo]]
            o = out[todo]
            todo = todo[(o >= 0) & (self.keys[o] != keys[todo])]
        return out


class Model:
    """The context trie: per order its nodes (contexts) and edges (context, symbol).

    A shorter context has seen every symbol that a longer one has, so the
    symbols excluded at one order are those of the node one order above, and
    every node can hold the costs of what follows an escape from it.
    """

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray]], whole: bool = True):
        """``orders[i]``: sorted (context of i bytes, symbol) numbers and their counts.

        ``whole``: the longest contexts are all there; if not, the others are left open.
        """
        self.edges, self.nodes, self.whole = [], [], whole
        below = None                                 # (places, total, distinct, count) one order below
        for i, (keys, n) in enumerate(orders):
            keys, n = keys.astype(np.uint64), n.astype(np.float64)
            context, row = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.bincount(row, n, len(context)), np.bincount(row, minlength=len(context))
            escape = np.where(distinct < 256, distinct, 0)
            whole = np.maximum(total + escape, 1)
            edges, nodes = Places(keys), Places(context)
            stats = {"escape": _log(escape / whole)}
            if i:
                mask = np.uint64((1 << 8 * i) - 1)   # symbol and the i - 1 bytes before it
                up = below["edges"].find(keys & mask)
                hidden = np.bincount(row, below["n"][up], len(context))
                parent = below["nodes"].find(context & (mask >> np.uint64(8)))
                new = below["distinct"][parent] - distinct
                weight = np.where(below["distinct"][parent] < 256, new, 0)
                rest = below["total"][parent] - hidden + weight
                # what the next shorter context costs when this node's symbols are out
                stats["rest"] = _log(np.maximum(rest, 1))
                stats["escape_below"] = np.where(rest > 0, _log(weight / np.maximum(rest, 1)), 0.0)
            else:
                stats["rest"] = _log(np.maximum(256 - distinct, 1).astype(np.float64))
            self.edges.append((edges, _log(n), _log(n) - _log(whole)[row]))
            self.nodes.append((nodes, stats))
            below = {"edges": edges, "nodes": nodes, "n": n, "total": total, "distinct": distinct}

    def code(self, keys: np.ndarray) -> np.ndarray:
        """Log10 probability of each (context, symbol) number, nan where it is open."""
        out = np.zeros(len(keys))
        rest, escape = np.full(len(keys), np.nan), np.zeros(len(keys))   # nan: no longer context known
        open_ = np.arange(len(keys))
        for i in reversed(range(len(self.edges))):
            (edges, log_n, log_top), (nodes, stats) = self.edges[i], self.nodes[i]
            k = keys[open_] & np.uint64((1 << 8 * (i + 1)) - 1)
            place = edges.find(k)
            hit = place >= 0
            done, p = open_[hit], place[hit]
            out[done] += np.where(np.isnan(rest[done]), log_top[p], log_n[p] - rest[done])
            open_, k = open_[~hit], k[~hit]
            if not len(open_):
                return out
            node = nodes.find(k >> np.uint64(8))
            known = node >= 0
            if not self.whole and i == len(self.edges) - 1:
                out[open_[~known]] = np.nan
                open_, node, known = open_[known], node[known], known[known]
            at, node = open_[known], node[known]
            out[at] += np.where(np.isnan(rest[at]), stats["escape"][node], escape[at])
            rest[at] = stats["rest"][node]
            escape[at] = stats["escape_below"][node] if i else 0.0
        out[open_] -= np.where(np.isnan(rest[open_]), np.log10(256), rest[open_])
        return out

    def scores(self, raws: list[bytes]) -> list[float]:
        """Log10 probability of each text (of its bytes that are not open)."""
        return self.parted(raws)[0]

    def parted(self, raws: list[bytes]) -> tuple[list[float], np.ndarray, np.ndarray, np.ndarray]:
        """(scores without the open bytes, text, (context, symbol) number and count of the open ones)."""
        out, left, first = [], [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
        for part in chunks(raws):
            keys, starts = grams(part, len(self.edges) - 1)
            logs = self.code(keys)
            open_ = np.flatnonzero(np.isnan(logs))
            logs[open_] = 0.0
            out += np.add.reduceat(logs, starts).tolist()
            if len(open_):
                text, keys = np.searchsorted(starts, open_, side="right") - 1 + first, keys[open_]
                place = np.lexsort((keys, text))
                text, keys = text[place], keys[place]
                new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])])
                left.append((text[new], keys[new], np.diff(np.r_[new, len(keys)])))
            first += len(part)
        return out, *(np.concatenate(x) for x in zip(*left))


def _log(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log10(x)


def lower_orders(keys: np.ndarray, counts: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counts of every order 0..order from those of the highest."""
    out = []
    for i in range(order + 1):
        k, row = np.unique(keys & np.uint64((1 << 8 * (i + 1)) - 1), return_inverse=True)
        out.append((k, np.bincount(row, counts, len(k))))
    return out


# ------------------------------------------------------------- counting

def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def corpus_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """gram (context and symbol as a number) or word (bytes; empty: the end of a text), and n, its count."""
    def batch(words: dict, counted=None) -> pa.RecordBatch:
        keys, counts = counted or (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        none = len(words)
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.nulls(none, pa.int64()), pa.array(keys.astype(np.int64))]),
            pa.concat_arrays([pa.array(list(words), pa.binary()), pa.nulls(len(keys), pa.binary())]),
            pa.concat_arrays([pa.array(list(words.values()), pa.int64()), pa.array(counts)])],
            names=["gram", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:                                # memory: one batch's texts and its counts
            words: Counter = Counter()
            raws = [_raw(t) for t in b.column(0).to_pylist()]
            for raw in raws:
                words.update(raw.lower().split())
                words[b""] += 1
                if len(words) >= FLUSH_WORDS:
                    yield batch(words)
                    words = Counter()
            yield batch(words, gram_counts(raws, order))

    counts = docs.select("text").mapInArrow(run, "gram bigint, word binary, n bigint")
    return counts.groupBy("gram", "word").agg(F.sum("n").alias("n"))


def least_count(df: DataFrame, most: int, size: Column | None = None) -> int:
    """The least power of two such that rows with ``n`` of at least it sum up to ``most`` (in ``size``)."""
    size = F.lit(1) if size is None else size
    sums = df.agg(*[F.coalesce(F.sum(F.when(F.col("n") >= (1 << j), size)), F.lit(0)).alias(f"c{j}")
                    for j in range(48)]).head()
    return next((1 << j for j in range(48) if sums[j] <= most), 1 << 48)


def _low(gram: str, size: int) -> Column:
    return F.col(gram).bitwiseAND((1 << 8 * size) - 1)


def tables(counts: DataFrame, order: int = ORDER) -> list[tuple[DataFrame, DataFrame]]:
    """The whole trie: per order (gram, n) and (context, n, edges), its pairs and its contexts."""
    by_order = [counts.where("gram is not null").select("gram", "n")]
    for i in range(order, 0, -1):
        shorter = by_order[0].groupBy(_low("gram", i).alias("gram"))
        by_order.insert(0, stored(shorter.agg(F.sum("n").alias("n")), "ppm-order"))
    return [(e, stored(e.groupBy(F.shiftright("gram", 8).alias("context")).agg(
        F.sum("n").alias("n"), F.count("*").alias("edges")), "ppm-contexts")) for e in by_order]


def hot_part(trie: list[tuple[DataFrame, DataFrame]], share: float = SHARE, max_edges: int = MAX_EDGES):
    """Per order the (context, symbol) numbers and counts to broadcast, as sorted arrays.

    A context is among them if its count reaches that order's threshold, which never falls with the
    order: with a context, all its shorter ones are.
    """
    total = trie[0][1].agg(F.sum("n")).head()[0] or 0           # one row: the empty context
    out, least = [], max(1, math.ceil(share * total))
    for edges, contexts in trie:
        while (contexts.where(F.col("n") >= least).agg(F.sum("edges")).head()[0] or 0) > max_edges:
            least *= 2
        kept = contexts.where(F.col("n") >= least).select("context")
        keyed = edges.withColumn("context", F.shiftright("gram", 8))
        t = keyed.join(kept, "context", "left_semi").select("gram", "n").toArrow()
        place = np.argsort(t["gram"].to_numpy())
        out.append((t["gram"].to_numpy()[place].astype(np.uint64), t["n"].to_numpy()[place].astype(np.float64)))
    return out


def fit(counts: DataFrame, order: int = ORDER, share: float = SHARE, max_edges: int = MAX_EDGES):
    """Per order the (context, symbol) numbers of the trie's hot part and their counts."""
    return hot_part(tables(counts, order), share, max_edges)


def pair_costs(pairs: DataFrame, trie: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """gram, cost: log10 probability of each distinct (context, symbol) number, by joins with the whole trie.

    The same steps as ``Model.code``, from the shortest context up.  A pair's
    row of one order has its count there (``n``), its cost if coding starts
    there, and ``tail``, what it costs after an escape from there.  At most 256
    rows of an order share a row of the one below.
    """
    wanted = [stored(pairs.select("gram").distinct(), "ppm-open")]
    for i in range(len(trie) - 1, 0, -1):
        wanted.insert(0, stored(wanted[0].select(_low("gram", i).alias("gram")).distinct(), "ppm-open"))
    state = None
    for i, (edges, contexts) in enumerate(trie):
        here = wanted[i].withColumn("context", F.shiftright("gram", 8))
        known = here.select("context").distinct().join(contexts, "context").select(
            "context", F.col("n").alias("total"), F.col("edges").alias("distinct"))
        escape = F.when(F.col("distinct") < 256, F.col("distinct")).otherwise(0)
        whole = F.col("total") + escape
        stats = ["context", F.log10(whole).alias("whole"), F.log10(escape / whole).alias("escape")]
        if i:
            shorter, parents = trie[i - 1]
            up = (edges.withColumn("context", F.shiftright("gram", 8)).join(known.select("context"), "context")
                  .select("context", _low("gram", i).alias("gram")))
            hidden = up.join(shorter, "gram").groupBy("context").agg(F.sum("n").alias("hidden"))
            parents = parents.select(F.col("context").alias("parent"), F.col("n").alias("up_total"),
                                     F.col("edges").alias("up_distinct"))
            known = known.join(hidden, "context").withColumn("parent", _low("context", i - 1)).join(parents, "parent")
            weight = F.when(F.col("up_distinct") < 256, F.col("up_distinct") - F.col("distinct")).otherwise(0)
            rest = F.col("up_total") - F.col("hidden") + weight
            stats += [F.log10(F.greatest(rest, F.lit(1))).alias("rest"),
                      F.when(rest > 0, F.log10(weight / rest)).otherwise(0.0).alias("escape_below")]
        else:
            stats += [F.log10(F.greatest(256 - F.col("distinct"), F.lit(1))).alias("rest")]
        here = here.join(edges, "gram", "left").join(known.select(*stats), "context", "left")
        if i:
            here = here.withColumn("shorter", _low("gram", i)).join(state.select(
                F.col("gram").alias("shorter"), F.col("n").alias("n_below"), F.col("tail").alias("tail_below"),
                F.col("cost").alias("cost_below")), "shorter")
            tail = F.when(F.col("n_below").isNotNull(), F.log10("n_below") - F.col("rest")).otherwise(
                F.col("escape_below") + F.col("tail_below"))
        else:
            here, tail = here.withColumn("cost_below", -F.log10(F.lit(256.0))), -F.col("rest")
        cost = (F.when(F.col("whole").isNull(), F.col("cost_below"))
                .when(F.col("n").isNotNull(), F.log10("n") - F.col("whole")).otherwise(F.col("escape") + F.col("tail")))
        state = stored(here.withColumn("tail", tail).select("gram", "n", "tail", cost.alias("cost")), "ppm-costs")
    return state.select("gram", "cost")


_MODELS: dict = {}


def _worker(name: str, parts: dict):
    """Model and log10 of the frequent words' base probabilities, built once per Python worker.

    ``parts`` is this worker's copy of what was broadcast; it is emptied, as the model replaces it.
    """
    if name not in _MODELS:
        _MODELS.clear()
        logs = np.log10((parts.pop("counts") + 1) / parts.pop("denominator")).tolist()
        known = dict(zip(parts.pop("words"), logs))
        _MODELS[name] = (Model(parts.pop("orders"), whole=False), known)
    return _MODELS[name]


def scan_scores(docs: DataFrame, orders, words: list[bytes], counts: np.ndarray,
                denominator: float) -> DataFrame:
    """One row per document, one per document and distinct word that is not among ``words``, and
    one per document and distinct (context, symbol) pair that ``orders`` leave open."""
    name = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(
        {"orders": orders, "words": words, "counts": counts, "denominator": denominator})
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_tokens", "n_known", "base", "score", "word", "gram", "tf"]
    kinds = (pa.int64(), None, pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, logs = _worker(name, shared.value)
        for b in (x.slice(i, SLICE_ROWS) for x in batches for i in range(0, x.num_rows, SLICE_ROWS)):
            raws = [_raw(t) for t in b.column(2).to_pylist()]
            score, text, gram, times = model.parted(raws)
            totals, known, base, rare = [], [], [], ([], [], [])
            for row, raw in zip(b.column(0).to_pylist(), raws):
                seen = Counter(raw.lower().split())
                seen[b""] = 1
                s, k = 0.0, 0
                for word, n in seen.items():
                    v = logs.get(word)
                    if v is None:
                        rare[0].append(row)
                        rare[1].append(word)
                        rare[2].append(n)
                    else:
                        s += n * v
                        k += n
                totals.append(seen.total())
                known.append(k)
                base.append(s)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip((totals, known, base, score), kinds[2:6])),
                 *(pa.nulls(len(raws), t) for t in kinds[6:])], names=names)
            n = len(rare[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rare[0], pa.int64()), pa.nulls(n, b.column(1).type),
                 *(pa.nulls(n, t) for t in kinds[2:6]), pa.array(rare[1], pa.binary()),
                 pa.nulls(n, pa.int64()), pa.array(rare[2], pa.int64())], names=names)
            n = len(gram)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(text)), pa.nulls(n, b.column(1).type),
                 *(pa.nulls(n, t) for t in kinds[2:7]), pa.array(gram.astype(np.int64)), pa.array(times, pa.int64())],
                names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(run, f"row bigint, doc_id {kind}, n_tokens bigint, n_known bigint, base double, "
                                "score double, word binary, gram bigint, tf bigint")


def document_scores(docs: DataFrame, folds: int = 7, held: int = 2, order: int = ORDER,
                    share: float = SHARE, max_edges: int = MAX_EDGES, max_frequent: int = MAX_FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    if not 0 <= order <= 6:
        raise ValueError("order must be 0 to 6: a context and its symbol are kept as one 64-bit number")
    train = docs.where(F.coalesce(fold(F.col("doc_id"), folds) != held, F.lit(True)))
    counts = stored(corpus_counts(train, order), "ppm-counts")
    words = counts.where("word is not null").select("word", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    denominator = float(total + distinct + 1)
    short = words.where(F.octet_length("word") <= WORD_BYTES)
    frequent = short.where(F.col("n") >= least_count(short, max_frequent)).toArrow()
    trie = tables(counts, order)
    orders = hot_part(trie, share, max_edges)
    scan = stored(scan_scores(docs, orders, frequent["word"].to_pylist(),
                              frequent["n"].to_numpy().astype(np.float64), denominator), "ppm-scan")
    rare = scan.where("word is not null").select("row", "word", "tf").join(words, "word", "left")
    gain = F.col("tf") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(denominator))
    more = rare.select("row", gain.alias("base"), F.when(F.col("n") > 0, F.col("tf")).alias("known"),
                       F.lit(0.0).alias("score"))
    pairs = scan.where("gram is not null").select("row", "gram", "tf")
    more = more.unionByName(pairs.join(pair_costs(pairs, trie), "gram").select(
        "row", F.lit(0.0).alias("base"), F.lit(None).cast("long").alias("known"),
        (F.col("tf") * F.col("cost")).alias("score")))
    more = more.groupBy("row").agg(*[F.sum(c).alias(f"more_{c}") for c in ("base", "known", "score")])
    rows = scan.where("word is null and gram is null").join(more, "row", "left")
    return rows.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
