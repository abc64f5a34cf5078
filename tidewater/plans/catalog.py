"""All registered test queries and their oracles."""

from __future__ import annotations

from tidewater.plans import queries_core, queries_io, queries_ml  # noqa: F401  (registers)
from tidewater.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
