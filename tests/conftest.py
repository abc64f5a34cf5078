from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="tidewater-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


def rows(df, *cols):
    """Collected rows as sorted tuples (tests only, small inputs)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
