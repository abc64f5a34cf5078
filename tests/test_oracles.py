"""Every query with an oracle equals DuckDB on sf0.001; the registry is sound."""
from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import _close, _rows, type_diffs  # noqa: E402
from tidewater.plans import catalog  # noqa: E402
from tidewater.sources.tables import TABLE_NAMES, table_path  # noqa: E402

ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(small_dir):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.sql(f"create view {t} as select * from '{table_path(small_dir, t)}'")
    yield con
    con.close()


def test_registry_is_consistent():
    qs = catalog.queries()
    assert set(ORACLES) <= set(qs) <= set(entry.queries())
    assert len(qs) >= 90
    for bad in ("pipeline", "llm"):
        assert not any(bad in k for k in qs)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["course_id", "title", "score"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, small_dir, key):
    df = entry.queries()[key](spark, small_dir)
    schema = df.schema
    pdf = df.toPandas()
    srows = _rows(list(pdf.columns), pdf.itertuples(index=False, name=None))
    rel = duck.sql(ORACLES[key])
    orows = _rows(list(rel.columns), rel.fetchall())
    assert sorted(pdf.columns) == sorted(rel.columns)
    assert type_diffs(schema, rel) == []
    assert len(srows) == len(orows)
    assert srows == orows or _close(srows, orows)


@pytest.mark.parametrize("key", ["sliding_window_60m_1m", "top_k_per_window", "stream_tumbling_update",
                                 "filter_row_predicate", "log_level_by_month"])
def test_time_queries_match_in_a_non_utc_session(spark, duck, small_dir, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")      # +05:30
    try:
        pdf = entry.queries()[key](spark, small_dir).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = duck.sql(ORACLES[key])
    assert _rows(list(pdf.columns), pdf.itertuples(index=False, name=None)) == \
        _rows(list(rel.columns), rel.fetchall())
