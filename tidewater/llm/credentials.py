"""Secret scan: credentials whose parts are linked by an interval join.

Every text is scanned once for parts of credentials.  Strong parts (assigned
secrets, access keys, long hexadecimal runs) are reported as they are.  Weak
candidates (user names and e-mail addresses, unlabelled random tokens,
addresses of services) are ordinary text on their own; they are reported only
if a complementary part lies within ``reach`` characters in the same scope:

    id        needs a secret, strong or weak
    secret    needs an id, strong or weak
    endpoint  needs a secret that is reported itself

A scope is a run of lines without a blank line between them.  The interval
join cuts each scope into bins of ``reach`` characters.  Parts are first
reduced to one row per (bin, role) that holds the least start and the greatest
end of what lies in the bin: that is all a candidate's distance test needs, so
a scope full of parts joins in linear size and no pairs are listed.

Kinds and their order: assign, access, hex (strong), id, secret, endpoint.
Positions are code points, ends exclusive.

Defined results: null and empty texts have no spans; repeated rows (equal
doc_id and text) each get a row with the same spans; rows of equal doc_id and
different texts are told apart by the text's hash; a null doc_id is an id like
any other; an empty table gives none; extra columns are ignored; a text is
scanned whole at any length, in time linear in it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import stored

KINDS = ("assign", "access", "hex", "id", "secret", "endpoint")
STRONG = KINDS[:3]
#: A weak candidate of the first kind needs a part of the second role near it.
NEEDS = {"id": "secret", "secret": "id"}

# The strong patterns.  A match that fails its length is dropped after matching; the shorter
# forms of access and hex match the same runs, for both take a run of characters whole.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

# The weak patterns begin where a run of their characters begins, so each run is read once.
ID_NAME = re.compile(
    r"""(?<![A-Za-z0-9])(?:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{3,})""", re.ASCII | re.IGNORECASE)
ID_WORDS = ("user", "login", "account", "client", "access")
MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
URL = re.compile(r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20"'<>]+""")
HOST_PORT = re.compile(r"(?<![A-Za-z0-9.-])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}(?![0-9])")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
TOKEN_BITS = 3.5                                # entropy per character of a random token
BREAK = re.compile(r"\n[\x20\t\r]*(?=\n)")       # a blank line ends a scope

REACH = 200                                     # characters between complementary parts


def strong_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the strong parts, leftmost and non-overlapping within each kind."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def _random(token: str) -> bool:
    """Upper and lower case, a digit and the entropy of a random string."""
    if not (any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= TOKEN_BITS


def weak_spans(text: str, strong: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the weak candidates; none overlaps a strong part or one before it in the list."""
    found = []
    if "://" in text:
        found += [("endpoint", m.start(), m.end()) for m in URL.finditer(text)]
    if ":" in text:
        found += [("endpoint", m.start(), m.end()) for m in HOST_PORT.finditer(text)]
    if "@" in text:
        found += [("id", m.start(), m.end()) for m in MAIL.finditer(text)]
    low = text.lower()
    if any(w in low for w in ID_WORDS):
        found += [("id", m.start(), m.end()) for m in ID_NAME.finditer(text)]
    found += [("secret", m.start(), m.end()) for m in TOKEN.finditer(text) if _random(m.group())]
    return _apart(found, strong)


def _apart(found: list, taken: list) -> list:
    """``found`` without what overlaps ``taken`` or an earlier entry: by start, ties in the given order."""
    if not found:
        return []
    marks = sorted([(s, e, -1, None) for _, s, e in taken]
                   + [(s, e, i, (k, s, e)) for i, (k, s, e) in enumerate(found)], key=lambda x: (x[0], x[2]))
    starts = sorted(s for _, s, _ in taken)
    out, reached = [], -1
    for s, e, _, part in marks:
        if part is None:
            reached = max(reached, e)
        elif s >= reached:
            i = bisect_right(starts, s)
            if i == len(starts) or starts[i] >= e:           # no strong part begins inside it
                out.append(part)
                reached = max(reached, e)
    return out


def _role(kind: str, value: str) -> str | None:
    """What a part is to its neighbours; a run of digits or a short hexadecimal number is nothing."""
    if kind == "hex":
        return "secret" if len(value) >= 32 and not value.isdigit() and not value.isalpha() else None
    return {"assign": "secret", "access": "id"}.get(kind, kind)


PART = pa.struct([("role", pa.string()), ("weak", pa.bool_()), ("kind", pa.string()),
                  ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int64())])
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bases, parts = [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            strong = strong_spans(text)
            weak = weak_spans(text, strong)
            bases.append([{"kind": k, "start": s, "end": e} for k, s, e in strong])
            mine = []
            if weak:
                breaks = [m.end() for m in BREAK.finditer(text)]
                for k, s, e in strong + weak:
                    role = _role(k, text[s:e])
                    if role:
                        mine.append({"role": role, "weak": k not in STRONG, "kind": k, "start": s, "end": e,
                                     "scope": bisect_right(breaks, s)})
            parts.append(mine)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("_text_key"), pa.array(bases, pa.list_(SPAN)),
             pa.array(parts, pa.list_(PART))], names=["doc_id", "_text_key", "base", "parts"])


def found_parts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, _text_key, base (strong spans), parts (with role and scope; only
    where there is a weak candidate)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.xxhash64("text").alias("_text_key"), "text")
    return slim.mapInArrow(
        _scan, f"doc_id {kind}, _text_key bigint, base array<struct<kind:string,start:bigint,end:bigint>>, "
               "parts array<struct<role:string,weak:boolean,kind:string,start:bigint,end:bigint,scope:bigint>>")


PLACE = ["doc_id", "_text_key", "kind", "start", "end", "scope"]


def near(weak: DataFrame, parts: DataFrame, reach: int) -> DataFrame:
    """The rows of ``weak`` (PLACE, needed) with a part of the needed role within ``reach`` in their
    scope; ``partner`` is the first position of such a part."""

    def bins(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor(lo / reach), F.floor(hi / reach))).alias("bin")

    at = ["_text_key", "scope", "bin"]
    cells = parts.select("*", bins(F.col("start"), F.col("end") - 1)).groupBy("doc_id", *at, "role").agg(
        F.min(F.greatest("start", F.col("bin") * reach)).alias("lo"),
        F.max(F.least("end", (F.col("bin") + 1) * reach)).alias("hi")).alias("c")
    w = weak.select("*", bins(F.col("start") - reach, F.col("end") - 1 + reach)).alias("w")
    close = F.col("w.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("w.needed") == F.col("c.role"))
    for k in at:
        close = close & (F.col(f"w.{k}") == F.col(f"c.{k}"))
    close = close & (F.col("c.lo") - F.col("w.end") <= reach) & (F.col("w.start") - F.col("c.hi") <= reach)
    return w.join(cells, close).groupBy(*[F.col(f"w.{c}") for c in PLACE]).agg(F.min("c.lo").alias("partner"))


def linked_parts(found: DataFrame, reach: int = REACH) -> DataFrame:
    """The reported weak candidates: PLACE and ``partner``.  Two joins: ids with secrets, then endpoints
    with the secrets that are strong or were linked."""
    rows = found.where(F.exists("parts", lambda p: p["weak"])).select("doc_id", "_text_key", F.explode("parts").alias("p"))
    rows = rows.select("doc_id", "_text_key", "p.*").distinct()
    needs = F.create_map(*[F.lit(x) for pair in NEEDS.items() for x in pair])
    pairs = near(rows.where(F.col("weak") & F.col("kind").isin(*NEEDS)).select(*PLACE, needs[F.col("kind")].alias("needed")),
                 rows, reach)
    pairs = stored(pairs, "credential-pairs")
    secrets = rows.where("role = 'secret' and not weak").select(*PLACE, "role").unionByName(
        pairs.where("kind = 'secret'").select(*PLACE, F.lit("secret").alias("role")))
    return pairs.unionByName(near(rows.where("kind = 'endpoint'").select(*PLACE, F.lit("secret").alias("needed")),
                                  secrets, reach))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("s"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("e"), s["kind"].alias("n")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
        ":", s["n"], s["s"].cast("string"), s["e"].cast("string"))), ",")


def document_spans(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: doc_id, ``base`` and ``linked`` spans (arrays of kind, start, end)."""
    found = stored(found_parts(docs), "credential-parts")
    linked = linked_parts(found, reach).groupBy("doc_id", "_text_key").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("linked"))
    some = F.exists("parts", lambda p: p["weak"])
    a, b = found.where(some).alias("a"), linked.alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a._text_key").eqNullSafe(F.col("b._text_key")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    with_weak = a.join(b, same, "left").select("a.doc_id", "a.base", F.coalesce("b.linked", none).alias("linked"))
    return found.where(~some).select("doc_id", "base", none.alias("linked")).unionByName(with_weak)


def document_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_linked of every document."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return document_spans(docs, reach).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "linked")).alias("spans"), F.size("linked").cast("long").alias("n_linked"))
