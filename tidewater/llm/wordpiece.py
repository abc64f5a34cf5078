"""Token counts by greedy longest match, in time linear in the text.

A vocabulary is split into pieces that begin a word and pieces that go on with
one; both go into one trie with two roots.  Greedy matching takes the longest
piece each time, which naively re-reads characters after every piece.  Here
each trie node has a failure link: the node that matching is in after the
pieces on the way are taken (popped), and the number of those pieces is
precomputed.  So a word is counted in one pass, without building its pieces:
on a missing edge the popped count is added and matching goes on at the
failure link, never back in the word.

Words are counted once per batch of documents, with a bounded cache of counts
per Python worker, so frequent words cost one lookup.  The vocabulary is a
file given by path, read on the driver and broadcast: its size is that of the
vocabulary, not of the data.  No rows are shuffled.

Defined results: null, empty and blank texts have 0 words and 0 tokens; a word
that the pieces cannot cover counts as one unknown token; repeated rows each
get a row; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

CACHE_WORDS, CACHE_LENGTH = 500_000, 64
WORD_START = b" "


def read_ranked_vocabulary(path: str) -> list[bytes]:
    """Pieces of a file with one base64 piece and its rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class LongestMatch:
    """Trie of byte pieces with failure links and popped-piece counts.

    ``start``: pieces that may begin a word; ``inner``: pieces that may go on.
    Node 0 is the start root, node 1 the inner root.
    """

    def __init__(self, start: Iterable[bytes], inner: Iterable[bytes]):
        self.edges: list[dict[int, int]] = [{}, {}]
        ends = set()
        for root, pieces in ((0, start), (1, inner)):
            for piece in pieces:
                node = root
                for byte in piece:
                    nxt = self.edges[node].get(byte)
                    if nxt is None:
                        nxt = len(self.edges)
                        self.edges[node][byte] = nxt
                        self.edges.append({})
                    node = nxt
                if piece:
                    ends.add(node)
        # -1: no failure link.  Breadth first, so a parent's link is known.
        n = len(self.edges)
        self.fail, self.popped = [-1] * n, [0] * n
        layer = [(0, b, c) for b, c in self.edges[0].items()] + [(1, b, c) for b, c in self.edges[1].items()]
        while layer:
            below = []
            for parent, byte, node in layer:
                if node in ends:                      # the path is a piece: pop it, go on inside a word
                    self.fail[node], self.popped[node] = 1, 1
                else:                                 # pop what the parent pops, then follow the edge
                    at, count = self.fail[parent], self.popped[parent]
                    while at >= 0 and byte not in self.edges[at]:
                        count += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.popped[node] = self.edges[at][byte], count
                below += [(node, b, c) for b, c in self.edges[node].items()]
            layer = below

    def count(self, word: bytes) -> int:
        """Pieces of the word; -1 if the pieces cannot cover it."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, total = 0, 0
        for byte in word:
            nxt = edges[node].get(byte)
            while nxt is None:
                if fail[node] < 0:
                    return -1
                total += popped[node]
                node = fail[node]
                nxt = edges[node].get(byte)
            node = nxt
        while node > 1:                               # what is left must end with the word
            if fail[node] < 0:
                return -1
            total += popped[node]
            node = fail[node]
        return total


def split_vocabulary(pieces: Iterable[bytes]) -> tuple[list[bytes], list[bytes]]:
    """(pieces that begin a word, marked by a leading space; the others)."""
    pieces = list(pieces)
    return ([p for p in pieces if p.startswith(WORD_START)],
            [p for p in pieces if not p.startswith(WORD_START)])


_AUTOMATA: dict[str, tuple[LongestMatch, dict]] = {}


def _automaton(name: str, pieces: list[bytes]) -> tuple[LongestMatch, dict]:
    """The automaton and count cache of this Python worker, built once."""
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[name] = (LongestMatch(*split_vocabulary(pieces)), {})
    return _AUTOMATA[name]


def token_counts(docs: DataFrame, pieces: list[bytes]) -> DataFrame:
    """doc_id, n_bytes, n_words, n_tokens, n_unknown, longest_word_tokens of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match, known = _automaton(*shared.value)
        for batch in batches:
            out = {"n_bytes": [], "n_words": [], "n_tokens": [], "n_unknown": [], "longest": []}
            for text in batch.column(1).to_pylist():
                raw = (text or "").encode("utf-8", "surrogatepass")
                words = Counter(raw.split())
                tokens = unknown = longest = 0
                for word, n in words.items():
                    c = known.get(word)
                    if c is None:
                        c = match.count(WORD_START + word)
                        if len(word) <= CACHE_LENGTH:
                            if len(known) >= CACHE_WORDS:
                                known.clear()
                            known[word] = c
                    if c < 0:
                        unknown += n
                        c = 1
                    tokens += n * c
                    longest = max(longest, c)
                for name, x in zip(out, (len(raw), words.total(), tokens, unknown, longest)):
                    out[name].append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.int64()) for v in out.values())],
                names=["doc_id", "n_bytes", "n_words", "n_tokens", "n_unknown", "longest_word_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_words bigint, n_tokens bigint, n_unknown bigint, "
             "longest_word_tokens bigint")
