"""Conversation repair against a search over all edit scripts and a plain string DP."""
from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidewater.llm import repair
from tidewater.llm.common import read

ROWS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
INSERT = {0: 2, 1: 2, 2: 3, 3: 2}


def plain(rows) -> tuple[int, str]:
    """The same DP with whole strings in its cells."""
    def closure(cells):
        for _ in range(2):
            more = dict(cells)
            for q, (c, s) in cells.items():
                more[INSERT[q]] = min(more.get(INSERT[q], (1 << 60, "")), (c + 5, s + "I"))
            cells = more
        return cells

    cells = {0: (0, "")}
    for initial, fault in rows:
        out = defaultdict(lambda: (1 << 60, ""))
        for q, (c, s) in closure(cells).items():
            out[q] = min(out[q], (c + 2, s + "D"))
            if fault in (0, 3):
                more = 5 if fault == 3 else 0
                if initial in STEPS[q]:
                    to = STEPS[q][initial]
                    out[to] = min(out[to], (c + more, s + "K"))
                out[INSERT[q]] = min(out[INSERT[q]], (c + 1 + more, s + "R"))
        cells = dict(out)
    return min(v for q, v in closure(cells).items() if q in (0, 3))


def scripts(rows) -> tuple[int, str]:
    """All scripts with at most two inserts at a place."""
    best = (1 << 60, "")
    for edits in itertools.product("KRD", repeat=len(rows)):
        for ins in itertools.product(range(3), repeat=len(rows) + 1):
            audit, cost, initials, q, ok = "", 0, "", 0, True
            for i in range(len(rows) + 1):
                for _ in range(ins[i]):
                    audit, cost, q = audit + "I", cost + 5, INSERT[q]
                    initials += "ua"[q == 3]
                if i == len(rows):
                    break
                initial, fault = rows[i]
                audit += edits[i]
                if edits[i] == "D":
                    cost += 2
                    continue
                ok &= fault in (0, 3)
                cost += 5 if fault == 3 else 0
                if edits[i] == "R":
                    cost, q = cost + 1, INSERT[q]
                    initials += "ua"[q == 3]
                else:
                    ok &= initial in STEPS[q]
                    q = STEPS[q].get(initial, q)
                    initials += initial
                if not ok:
                    break
            if ok and re.fullmatch("(s?(ua)+)?", initials):
                best = min(best, (cost, audit))
    return best


def test_cheapest_equals_all_scripts():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice("suax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 4))]
        assert repair.cheapest(rows) == scripts(rows) == plain(rows), rows


def test_cheapest_equals_string_dp_on_long_conversations():
    rng = random.Random(2)
    for n in (50, 400, 3000):
        rows = [(rng.choice("suuaa"), rng.choice([0, 0, 0, 1, 2, 3, 3])) for _ in range(n)]
        assert repair.cheapest(rows) == plain(rows)
        assert repair.cheapest([("u", 0)] * n) == plain([("u", 0)] * n)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7])
def test_chunks_compose_to_the_whole(chunk):
    rng = random.Random(chunk)
    for _ in range(150):
        rows = [(rng.choice("suax"), rng.choice([0, 0, 0, 1, 3])) for _ in range(rng.randint(1, 30))]
        cells = [repair.matrix(rows[i:i + chunk]) for i in range(0, len(rows), chunk)]
        cost, path, closing = repair.best_chain([[c[:4] for c in m] for m in cells])
        audit = "".join({(b, a): s for b, a, _, _, s in m}[p] for m, p in zip(cells, path)) + closing
        assert (cost, audit) == plain(rows)


def test_audits_compare_like_strings_also_with_equal_hashes(monkeypatch):
    for base in (repair._BASE, 0):                     # with base 0 most hashes collide
        monkeypatch.setattr(repair, "_BASE", base)
        rng = random.Random(4)
        audits, nodes = repair.Audits(), {"": [0]}
        for _ in range(400):
            s = rng.choice(list(nodes))
            x = rng.choice("DIKR")
            nodes.setdefault(s + x, []).append(audits.add(rng.choice(nodes[s]), x))
        pool = list(nodes)
        for _ in range(3000):
            s, t = rng.choice(pool), rng.choice(pool)
            assert audits.less(rng.choice(nodes[s]), rng.choice(nodes[t])) == (s < t)


def brute(rows) -> list[tuple]:
    by_conv = defaultdict(list)
    for c, turn, role, text in rows:
        by_conv[c].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for c, ts in by_conv.items():
        ts.sort(key=lambda t: (t[0] is not None, t[0] or 0))
        after = []
        for turn, role, text in ts:
            h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if h:
                text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
                after += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
        faults, seen = [], set()
        for _, role, text in after:
            bare = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        cost, audit = plain([(r[:1], f) for (_, r, _), f in zip(after, faults)])
        real = [t for t, _, _ in after if t is not None]
        body, i, q = [], 0, 0
        for x in audit:
            if x == "I":
                q = INSERT[q]
                body.append(("assistant" if q == 3 else "user") + ":")
                continue
            _, role, text = after[i]
            i += 1
            if x == "R":
                q = INSERT[q]
                role = "assistant" if q == 3 else "user"
            if x == "K":
                q = STEPS[q][role[:1]]
            if x != "D":
                body.append(f"{role}:{text}")
        initials = [r[:1] for _, r, _ in after]
        out.append((c, max(real) - min(real) + 1 - len(set(real)) if real else 0, faults.count(1), faults.count(2), faults.count(3),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(body).encode()).hexdigest()))
    return out


def _key(row):
    return (row[0] is not None, row[0] or 0)


def got(df) -> list[tuple]:
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=_key)


def awkward() -> list[tuple]:
    rng = random.Random(8)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"]
    texts = ["One two.", "What?", "no end", "  \t", "", None, "Stop! ", "ends.\n", "é…", "w. " * 4000, "long " * 4000]
    rows = []
    for c in [*range(120), None]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([None, 3 * t]) if t == 0 else 3 * t + rng.randint(0, 2), rng.choice(roles), rng.choice(texts)))
    rows += [(500, 2 ** 62 + t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(300)]
    rows += [(501, t, "user", "The same.") for t in range(200)]
    rows += [(502, None, "user", "Null turn."), (502, None, "user", "Null turn.")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 40])
def test_repair_equals_brute_force(spark, partitions, monkeypatch):
    rows = awkward()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 as piece", "2 as audit", "3 as pos", "4 as cost", "5 as copy",
                                                          "6 as split")
        assert got(repair.repaired_conversations(df)) == sorted(brute(rows), key=_key)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_long_conversation_in_many_chunks(spark):
    """One conversation holds most rows: it goes through ranges, chunks and the chain of chunks."""
    rows = [(7, t, ("user", "assistant")[(t // 3) % 2], f"Text {t % 9000}" + ".?"[t % 2]) for t in range(30_000)]
    rows += [(c, t, "user", "Hi.") for c in range(20) for t in range(2) if c != 7]
    assert got(repair.repaired_conversations(spark.createDataFrame(rows, ROWS))) == sorted(brute(rows), key=_key)


def test_repair_of_the_table_and_of_none(spark, small_dir):
    table = read(spark, small_dir, "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(repair.repaired_conversations(table)) == sorted(brute(rows), key=_key)
    assert repair.repaired_conversations(table.where("false")).collect() == []
