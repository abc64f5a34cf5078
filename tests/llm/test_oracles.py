"""The operator queries with an oracle equal DuckDB on sf0.001."""
from __future__ import annotations

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from check_oracles import _close, _rows, type_diffs  # noqa: E402
from tidewater.llm import catalog  # noqa: E402
from tidewater.sources.tables import TABLE_NAMES, table_path  # noqa: E402


@pytest.mark.parametrize("key", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, small_dir, key):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.sql(f"create view {t} as select * from '{table_path(small_dir, t)}'")
    df = catalog.queries()[key](spark, small_dir)
    rel = con.sql(catalog.oracle_sql()[key])
    assert type_diffs(df.schema, rel) == []
    got, want = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(list(rel.columns), rel.fetchall())
    assert len(got) > 0 and (got == want or _close(got, want))
