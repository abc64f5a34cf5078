"""Conversation structure repair: the cheapest edits, by a persistent audit DP.

The role initials of a repaired conversation read ``(s?(ua)+)?``.  Rows are
kept (K, 0), given the role user or assistant (R, 1) or deleted (D, 2; the only
edit of blank and repeated rows); empty rows are inserted anywhere (I, 5); a
truncated row that stays costs 5 more.  Of the cheapest audits (the edits'
initials in order) the least in ASCII order is taken.

The DP runs over the rows with one cell per automaton state: its cost and its
audit, a node linked to the audit it extends, so cells share their beginnings.
Every node has its ancestors at distances 1, 2, 4, ... and a rolling hash.  Equal
costs are decided by a search for the longest common prefix over ancestors of
equal hash; equal hashes are verified by walking up to a shared node, and what
was verified is remembered.

Rows are dealt by range of (conversation, order), so a conversation is nobody's
whole task.  A task repairs the conversations that lie whole in its range.
Those at its two ends, and any beyond ``MAX_ROWS`` rows or ``MAX_CHARS``
characters, go on as single rows in chunks of ``CHUNK`` (exact, the same edits):
first occurrences by a grouping, one cost matrix (state before, state after) per
chunk, and the same DP over the chunks, with the rank of a chunk's audit among
the matrix's audits as letter.  An insert always stands before a row or at the
very end, so no audit of a chunk begins another one and ranks decide as the
audits would.

Bounds: a task holds one conversation of the stated size, a chunk, or a few
numbers per chunk of one conversation; its audit is one value of the result.

Defined results: turns are ordered null first, then by the row order given
(here role, text and copy); null role or text counts as one space; an empty
role has no initial and cannot be kept; a null conv_id is a conversation like
any other; repeated rows are repeated turns; an empty table gives none; extra
columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import stored, streamed_sha256

START, SYSTEM, USER, DONE = range(4)             # what has been read: nothing, s, ... u, ... a
INSERTED = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (DONE, "assistant"), DONE: (USER, "user")}
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): DONE, (DONE, "u"): USER}
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
BLANK, DUPLICATE, CUT = 1, 2, 3                  # faults; 0: none
MAX_ROWS, MAX_CHARS, CHUNK_BITS = 20_000, 8_000_000, 11
CHUNK = 1 << CHUNK_BITS

_MOD, _BASE = (1 << 61) - 1, 1_000_003


class Audits:
    """Strings of letters as linked nodes that share their beginnings; node 0 is empty."""

    def __init__(self):
        self.up: list[tuple[int, ...]] = [()]    # ancestors at distance 1, 2, 4, ...
        self.letter: list = [None]
        self.depth, self.hash, self.same = [0], [0], {}

    def add(self, node: int, letter) -> int:
        up, jump, k = [node], node, 0
        while len(self.up[jump]) > k:
            jump = self.up[jump][k]
            up.append(jump)
            k += 1
        self.up.append(tuple(up))
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        code = ord(letter) if isinstance(letter, str) else letter
        self.hash.append((self.hash[node] * _BASE + code + 1) % _MOD)
        return len(self.up) - 1

    def letters(self, node: int) -> list:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return out[::-1]

    def _at(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            k = (self.depth[node] - depth).bit_length() - 1
            node = self.up[node][k]
        return node

    def _known(self, node: int) -> int:
        while node in self.same:
            node = self.same[node]
        return node

    def _verified(self, x: int, y: int) -> bool:
        """Equal letters from the root to x and y, letter by letter to a shared node."""
        seen = []
        while (x := self._known(x)) != (y := self._known(y)):
            if self.letter[x] != self.letter[y]:
                return False
            seen.append((x, y))
            x, y = self.up[x][0], self.up[y][0]
        for x, y in seen:
            self.same[max(x, y)] = min(x, y)
        return True

    def fork(self, x: int, y: int) -> tuple[int, int]:
        """The nodes of x and y one past their longest common prefix; (0, 0) if one begins the other."""
        m = min(self.depth[x], self.depth[y])
        x, y = self._at(x, m), self._at(y, m)
        if self.hash[x] == self.hash[y] and self._verified(x, y):
            return 0, 0
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]):
                p, q = self.up[x][k], self.up[y][k]
                if p != q and not (self.hash[p] == self.hash[q] and self._verified(p, q)):
                    x, y = p, q
        return x, y

    def less(self, x: int, y: int) -> bool:
        p, q = self.fork(x, y)
        return self.letter[p] < self.letter[q] if p else self.depth[x] < self.depth[y]


Cells = dict[int, tuple[int, int]]               # state -> (cost, audit node)


def _offer(cells: Cells, audits: Audits, state: int, cost: int, node: int, letters: str) -> None:
    """Put node + letters into a cell if it is cheaper, or as cheap and less."""
    old = cells.get(state)
    if old is not None and old[0] < cost:
        return
    for x in letters:
        node = audits.add(node, x)
    if old is None or cost < old[0] or audits.less(node, old[1]):
        cells[state] = (cost, node)


def with_inserts(cells: Cells, audits: Audits) -> Cells:
    """The cells after any inserts; a third insert would only repeat a state."""
    out = dict(cells)
    for state, (cost, node) in cells.items():
        letters, at = "", state
        for _ in range(2):
            at, letters, cost = INSERTED[at][0], letters + "I", cost + COST["I"]
            _offer(out, audits, at, cost, node, letters)
    return out


def next_row(cells: Cells, audits: Audits, initial: str, fault: int) -> Cells:
    """The cells after one more row."""
    out: Cells = {}
    more = TRUNCATED if fault == CUT else 0
    for state, (cost, node) in with_inserts(cells, audits).items():
        _offer(out, audits, state, cost + COST["D"], node, "D")
        if fault in (BLANK, DUPLICATE):
            continue
        if (state, initial) in KEEP:
            _offer(out, audits, KEEP[state, initial], cost + COST["K"] + more, node, "K")
        _offer(out, audits, INSERTED[state][0], cost + COST["R"] + more, node, "R")
    return out


def finished(cells: Cells, audits: Audits) -> tuple[int, int]:
    """(cost, audit node) of the best accepted cell."""
    best: Cells = {}
    for state, (cost, node) in with_inserts(cells, audits).items():
        if state in (START, DONE):
            _offer(best, audits, 0, cost, node, "")
    return best[0]


def cheapest(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation given as (initial, fault) rows."""
    audits, cells = Audits(), {START: (0, 0)}
    for initial, fault in rows:
        cells = next_row(cells, audits, initial, fault)
    cost, node = finished(cells, audits)
    return cost, "".join(audits.letters(node))


def matrix(rows: list[tuple[str, int]]) -> list[tuple[int, int, int, int, str]]:
    """(state before, state after, cost, rank of the audit, audit) of some rows within a conversation."""
    out = []
    for before in range(4):
        audits, cells = Audits(), {before: (0, 0)}
        for initial, fault in rows:
            cells = next_row(cells, audits, initial, fault)
        out += [(before, after, cost, "".join(audits.letters(node))) for after, (cost, node) in sorted(cells.items())]
    rank = {audit: i for i, audit in enumerate(sorted({x[3] for x in out}))}
    return [(b, a, cost, rank[audit], audit) for b, a, cost, audit in out]


def best_chain(chunks: list[list[tuple[int, int, int, int]]]) -> tuple[int, list[tuple[int, int]], str]:
    """(cost, (state before, state after) of each chunk, closing inserts) of chunk matrices (before, after, cost, rank)."""
    audits, cells, steps = Audits(), {START: (0, 0)}, {0: None}
    for chunk in chunks:
        out: Cells = {}
        for before, after, cost, rank in chunk:
            if before in cells:
                _offer_rank(out, steps, audits, cells, before, after, cost, rank)
        cells = out
    closing = {START: "", SYSTEM: "II", USER: "I", DONE: ""}
    best = None
    for state, (cost, node) in cells.items():
        total = cost + COST["I"] * len(closing[state])
        if best is None or total < best[0] or (total == best[0] and audits.less(node, best[1])):
            best = (total, node, state)
    cost, node, state = best
    path, at = [], node
    while at:
        path.append(steps[at])
        at = audits.up[at][0]
    return cost, path[::-1], closing[state]


def _offer_rank(out: Cells, steps: dict, audits: Audits, cells: Cells, before: int, after: int, cost: int, rank: int) -> None:
    cost += cells[before][0]
    if after in out and out[after][0] < cost:
        return
    node = audits.add(cells[before][1], rank)
    if after not in out or cost < out[after][0] or audits.less(node, out[after][1]):
        out[after] = (cost, node)
        steps[node] = (before, after)


def applied(audit: str, rows: list[tuple[str, str]], state: int = START) -> list[tuple[str, str]]:
    """The (role, text) rows that the edits leave, from a state on."""
    out, i = [], 0
    for edit in audit:
        if edit == "I":
            state, role = INSERTED[state]
            out.append((role, ""))
            continue
        role, text = rows[i]
        i += 1
        if edit == "K":
            state = KEEP[state, role[:1]]
            out.append((role, text))
        elif edit == "R":
            state, role = INSERTED[state]
            out.append((role, text))
    return out


# ---- rows --------------------------------------------------------------------------------

INITIALS = ("su", "ua", "au")                    # legal neighbours
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_SUMS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
TOTALS = ", ".join(f"{c} bigint" for c in _SUMS)


def _checked(conversations: DataFrame, order: list[str]) -> DataFrame:
    """The rows with what the repair must know of each: _blank, _cut, _initial and _sig."""
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    bare = F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    order = [F.col(c).alias(f"_order{i}") for i, c in enumerate(order)]
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *order, role.alias("role"), text.alias("text"),
                                (bare == "").alias("_blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("_cut"),
                                F.substring(role, 1, 1).alias("_initial"),
                                F.struct(F.xxhash64(role, text).alias("x"), F.xxhash64(F.lit(1), text, role).alias("y")).alias("_sig"))


def _fault(blank: bool, again: bool, cut: bool) -> int:
    return BLANK if blank else DUPLICATE if again else CUT if cut else 0


def _totals(turns: list, rows: list[tuple[str, int]], cost: int) -> tuple[int, ...]:
    real = [t for t in turns if t is not None]
    faults = [f for _, f in rows]
    return (real[-1] - real[0] + 1 - len(set(real)) if real else 0, faults.count(BLANK), faults.count(DUPLICATE),
            faults.count(CUT), sum(a + b not in INITIALS for (a, _), (b, _) in zip(rows, rows[1:])), cost)


def _whole(rows: list[tuple]) -> tuple:
    """(audit, repaired turns, totals) of a conversation's (turn, role, text, blank, cut, initial, sig) rows."""
    seen, checked = set(), []
    for _, _, _, blank, cut, initial, sig in rows:
        checked.append((initial, _fault(blank, sig in seen, cut)))
        seen.add(sig)
    cost, audit = cheapest(checked)
    turns = [{"role": r, "text": t} for r, t in applied(audit, [x[1:3] for x in rows])]
    return audit, turns, _totals([x[0] for x in rows], checked, cost)


def _repair_ranges(kind: pa.DataType):
    """The task: closed conversations come out repaired, the rows of the others as they are with their place."""
    schema = pa.schema([("conv_id", kind), ("open", pa.bool_()), ("pos", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                        ("text", pa.string()), ("bare", pa.bool_()), ("cut", pa.bool_()), ("initial", pa.string()),
                        ("sig", pa.struct([("x", pa.int64()), ("y", pa.int64())])), ("audit", pa.string()), ("turns", _TURNS),
                        *[(c, pa.int64()) for c in _SUMS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        out: list[dict] = []
        held, chars, place, now = [], 0, 0, None
        is_open, first, begun = False, True, False

        def opened() -> None:
            nonlocal held, chars
            out.extend({"conv_id": now, "open": True, "pos": p, "turn": r[0], "role": r[1], "text": r[2], "bare": r[3],
                        "cut": r[4], "initial": r[5], "sig": {"x": r[6][0], "y": r[6][1]}} for p, r in held)
            held, chars = [], 0

        def closed() -> None:
            nonlocal held, chars
            audit, turns, totals = _whole([r for _, r in held])
            out.append({"conv_id": now, "open": False, "audit": audit, "turns": turns, **dict(zip(_SUMS, totals))})
            held, chars = [], 0

        def emit() -> pa.RecordBatch:
            nonlocal out
            batch, out = pa.RecordBatch.from_pylist(out, schema=schema), []
            return batch

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in
                       ("conv_id", "turn", "role", "text", "_blank", "_cut", "_initial", "_sig")]
            for conv, turn, role, text, blank, cut, initial, sig in zip(*columns):
                if not begun or conv != now:
                    if begun:
                        opened() if is_open or first else closed()
                        first = False
                    now, is_open, begun = conv, False, True
                held.append((base + place, (turn, role, text, blank, cut, initial, (sig["x"], sig["y"]))))
                place += 1
                chars += len(text)
                if is_open or len(held) > MAX_ROWS or chars > MAX_CHARS:
                    is_open = True
                    if len(held) >= CHUNK or chars > MAX_CHARS:
                        opened()
                if len(out) >= CHUNK:
                    yield emit()
        if held:
            opened()                                   # the range's last conversation may go on in the next one
        if out:
            yield emit()

    return run


def _chunk_matrices(kind: str):
    """One chunk of an open conversation: its cost matrix and totals; see ``_compose``."""
    import pandas as pd

    def run(rows: "pd.DataFrame") -> "pd.DataFrame":
        rows = rows.sort_values("pos")
        faults = [_fault(b, a, c) for b, a, c in zip(rows["bare"], rows["again"], rows["cut"])]
        cells = matrix(list(zip(rows["initial"], faults)))
        real = [int(t) for t in rows["turn"] if t is not None]
        pairs = list(zip(rows["initial"], rows["initial"].iloc[1:]))
        one = {"conv_id": rows["conv_id"].iloc[:1].repeat(len(cells)).values, "chunk": int(rows["chunk"].iloc[0]),
               "low": str(real[0]) if real else None, "high": str(real[-1]) if real else None, "n_turns": len(set(real)), "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
               "truncated": faults.count(CUT), "illegal": sum(a + b not in INITIALS for a, b in pairs),
               "head": rows["initial"].iloc[0], "tail": rows["initial"].iloc[-1]}
        out = pd.DataFrame(cells, columns=["before", "after", "cost", "rank", "audit"])
        for c, v in one.items():
            out[c] = v
        return out

    return run, (f"before int, after int, cost bigint, rank int, audit string, conv_id {kind}, chunk bigint, low string, "
                 "high string, n_turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
                 "head string, tail string")


def _compose(kind: str):
    """All chunks of an open conversation: each one's states and, with the last, closing inserts and totals."""
    import pandas as pd

    def run(rows: "pd.DataFrame") -> "pd.DataFrame":
        rows = rows.sort_values(["chunk", "before", "after"])
        groups = [g for _, g in rows.groupby("chunk", sort=True)]
        cost, path, closing = best_chain([list(zip(g["before"], g["after"], g["cost"], g["rank"])) for g in groups])
        ones = pd.concat([g.iloc[:1] for g in groups])
        known = ones.dropna(subset=["low"])
        gaps = 0
        if len(known):
            low, high = known["low"].map(int).tolist(), known["high"].map(int).tolist()
            gaps = high[-1] - low[0] + 1 - int(known["n_turns"].sum()) + sum(a == b for a, b in zip(high, low[1:]))
        bad = sum(a + b not in INITIALS for a, b in zip(ones["tail"], ones["head"].iloc[1:]))
        n = len(ones)
        out = pd.DataFrame({"conv_id": ones["conv_id"].values, "chunk": ones["chunk"].values,
                            "before": [p[0] for p in path], "after": [p[1] for p in path],
                            "closing": [""] * (n - 1) + [closing]})
        totals = {"gaps": gaps, "blank": ones["blank"].sum(), "duplicate": ones["duplicate"].sum(),
                  "truncated": ones["truncated"].sum(), "illegal": ones["illegal"].sum() + bad, "cost": cost}
        for c, v in totals.items():
            out[c] = pd.array([None] * (n - 1) + [int(v)], dtype="Int64")
        return out

    return run, f"conv_id {kind}, chunk bigint, before int, after int, closing string, {TOTALS}"


def _apply_chunks(kind: str):
    """A chunk's rows and its edits: the repaired turns of that piece."""
    import pandas as pd

    def run(rows: "pd.DataFrame", edits: "pd.DataFrame") -> "pd.DataFrame":
        rows, e = rows.sort_values("pos"), edits.iloc[0]
        turns = applied(e["audit"] + e["closing"], list(zip(rows["role"], rows["text"])), int(e["before"]))
        return pd.DataFrame({"conv_id": edits["conv_id"].values[:1], "piece": [int(e["chunk"])], "audit": [e["audit"] + e["closing"]],
                             "turns": [[{"role": r, "text": t} for r, t in turns]]})

    return run, f"conv_id {kind}, piece bigint, audit string, turns array<struct<role:string,text:string>>"


def _same(a: str, b: str):
    return F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))


def repaired(conversations: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(pieces, totals) of (conv_id, turn, role, text) rows.

    pieces: conv_id, split, piece, audit and turns (array of role, text), one row for most conversations;
    those with ``split`` have a row per chunk, in order of ``piece``.  totals: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost.  ``order`` names the columns that order rows within a turn.
    """
    kind = conversations.schema["conv_id"].dataType
    name = kind.simpleString()
    rows = _checked(conversations, order)
    by = ["conv_id", "turn", *[c for c in rows.columns if c.startswith("_order")]]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop(*by[2:])
    from pyspark.sql.pandas.types import to_arrow_type

    found = stored(rows.mapInArrow(_repair_ranges(to_arrow_type(kind)), (
        f"conv_id {name}, open boolean, pos bigint, turn bigint, role string, text string, bare boolean, cut boolean, "
        f"initial string, sig struct<x:bigint,y:bigint>, audit string, turns array<struct<role:string,text:string>>, {TOTALS}")),
        "repair-ranges")
    done = found.where("not open")

    rest = found.where("open").withColumn("chunk", F.shiftright("pos", CHUNK_BITS))
    firsts = rest.groupBy("conv_id", "sig").agg(F.min("pos").alias("first")).alias("f")
    marks = rest.select("conv_id", "chunk", "pos", "turn", "bare", "cut", "initial", "sig").alias("r")
    marks = marks.join(firsts, _same("r", "f") & (F.col("r.sig") == F.col("f.sig"))).select(
        "r.conv_id", "chunk", "pos", F.col("turn").cast("string").alias("turn"), "bare", "cut", "initial", (F.col("pos") > F.col("first")).alias("again"))
    run, schema = _chunk_matrices(name)
    cells = stored(marks.groupBy("conv_id", "chunk").applyInPandas(run, schema), "repair-chunks")
    run, schema = _compose(name)
    chosen = stored(cells.drop("audit").groupBy("conv_id").applyInPandas(run, schema), "repair-chosen")
    c, m = chosen.alias("c"), cells.alias("m")
    edits = c.join(m, _same("c", "m") & (F.col("c.chunk") == F.col("m.chunk")) & (F.col("c.before") == F.col("m.before"))
                   & (F.col("c.after") == F.col("m.after"))).select("c.conv_id", "c.chunk", "c.before", "m.audit", "c.closing")
    run, schema = _apply_chunks(name)
    pieces = rest.select("conv_id", "chunk", "pos", "role", "text").groupBy("conv_id", "chunk").cogroup(
        edits.groupBy("conv_id", "chunk")).applyInPandas(run, schema)
    pieces = done.select("conv_id", F.lit(False).alias("split"), F.lit(0).cast("long").alias("piece"), "audit", "turns").unionByName(
        pieces.withColumn("split", F.lit(True)))
    totals = done.select("conv_id", *_SUMS).unionByName(chosen.where("cost is not null").select("conv_id", *_SUMS))
    return pieces, totals


# ---- the registered query ------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy): every row by crc32(``conv_id:turn``) % 20: 0 is dropped, 1 loses its
    text, 2 its ``[.!?]``, 3 comes twice, 4 gets the role user.  ``sort_role`` and ``sort_text`` order the rows of one turn."""
    def filled(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    h = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(h == 1, "").when(h == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text"))
    copies = F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.where(h != 0).select(
        "conv_id", "turn", F.when(h == 4, "user").otherwise(filled("role")).alias("role"), text.alias("text"),
        filled("role").alias("sort_role"), F.xxhash64(filled("text")).alias("sort_text"), F.explode(copies).alias("copy"))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """Every conv_id with the figures, audit and digest of its repair after damage."""
    pieces, totals = repaired(damaged(conversations), ["sort_role", "sort_text", "copy"])
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    pieces = stored(pieces.select("conv_id", "split", "piece", "audit", body.alias("body"), (F.size("turns") > 0).alias("any")),
                    "repair-pieces")
    key = F.coalesce(F.concat(F.lit("id "), F.col("conv_id").cast("string")), F.lit("null")).alias("key")
    whole = pieces.where("not split").select("conv_id", "audit", F.sha2("body", 256).alias("sha256"))
    parts = pieces.where("split").select("conv_id", key, "piece", "audit", "body", "any")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda p: p["audit"]), "")
    joined = parts.groupBy("conv_id", "key").agg(listed.alias("audit")).join(
        streamed_sha256(parts.where("any"), "key", "piece", "body", "\n"), "key", "left")
    texts = whole.unionByName(joined.select("conv_id", "audit", "sha256")).alias("t")
    ids, totals = conversations.select("conv_id").distinct().alias("i"), totals.alias("n")
    out = ids.join(totals, _same("i", "n"), "left").join(texts, _same("i", "t"), "left")
    return out.select("i.conv_id", *[F.coalesce(F.col(f"n.{c}"), F.lit(0)).cast("long").alias(c) for c in _SUMS],
                      F.coalesce("t.audit", F.lit("")).alias("audit"),
                      F.coalesce("t.sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
