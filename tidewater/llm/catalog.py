"""Registry of the training-data queries and their DuckDB oracles."""

from __future__ import annotations

import corpus_pipeline

from tidewater.llm import oracles
from tidewater.llm.queries import QUERIES

ORACLES: dict[str, str] = {k: v.strip() for k, v in oracles.ORACLES.items()}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries():
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql():
    return dict(ORACLES)
