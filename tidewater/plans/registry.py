"""Registry of test queries: key -> (Spark callable, DuckDB oracle SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver's tables (or data Spark derives from them).  The oracle is an
independent ANSI-SQL statement over the same tables, with the same output
column names; ``None`` marks a query with no fair SQL equivalent (models,
streams with engine-specific emission), checked by unit tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def half_up(expr: str, digits: int) -> str:
    """Oracle form of Spark's ``round(double, d)``: HALF_UP on the decimal value.

    Spark rounds the double's decimal representation (2348.325 -> 2348.33);
    rounding the binary double directly can go the other way on exact ties.
    """
    return f"cast(round(cast({expr} as decimal(38, 10)), {digits}) as double)"


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn
    return deco
