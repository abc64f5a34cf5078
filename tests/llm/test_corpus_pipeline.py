"""The five stages: each one's decisions on its own input, against plain Python."""
from __future__ import annotations

from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline as C
from tests.llm.test_decontam import overlaps, tokens
from tests.llm.test_quality_rules import base
from tests.llm.test_simhash import brute_classes
from tidewater.llm.common import read, stored


def test_stages(spark, small_dir):
    docs, seen = read(spark, small_dir, "documents"), []
    columns = docs.columns
    for name, stage in C.STAGES:
        before = docs.collect()
        docs = stored(stage(spark, docs, small_dir), "test")
        seen.append((before, docs.collect()))
        assert docs.columns == (columns if name != "sharding" else [*columns, "shard", "slot"])
    (raw, kept), (_, one), (_, clean), (_, mixed), (_, placed) = seen
    assert all(not base(r.text)[-1] for r in kept)
    assert {r.doc_id for r in one} == {c[3] for c in brute_classes(kept)} and len(one) == len({r.doc_id for r in one})
    items = [tokens(b.text) for b in read(spark, small_dir, "benchmark").collect()]
    assert not any(overlaps(tokens(r.text), i) for r in clean[:40] for i in items)
    gone = [r for r in one if r not in set(clean)]
    assert gone and all(any(overlaps(tokens(r.text), i) for i in items) for r in gone)
    assert set(mixed) <= set(clean) and max(Counter(mixed).values()) <= 2
    assert Counter(tuple(r)[:5] for r in placed) == Counter(map(tuple, mixed))
    sizes = Counter(r.shard for r in placed)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(40)) <= 1


def test_run_gives_the_last_stage(spark, small_dir):
    out = C.run(spark, small_dir)
    assert out.columns[-2:] == ["shard", "slot"] and out.count() > 0


def test_empty_tables(spark, small_dir, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        read(spark, small_dir, t).where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert 4 <= len(C.STAGES) <= 5
