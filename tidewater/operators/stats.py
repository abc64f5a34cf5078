"""Correlation of one target column with many columns in a single pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in set(exclude)]


def correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                 digits: int | None = None, name_col: str = "feature",
                 value_col: str = "corr") -> DataFrame:
    """Pearson correlation of ``target`` with each column, as rows (feature, corr).

    One global aggregate computes every coefficient (partial aggregates per
    task, one tiny final merge) instead of one job per column; ``stack``
    unpivots the single result row.  The target itself is left out.
    """
    cols = [c for c in (columns if columns is not None else numeric_columns(df)) if c != target]
    if not cols:
        raise ValueError("no column to correlate with")
    aggs = []
    for i, c in enumerate(cols):
        r = F.corr(F.col(target).cast("double"), F.col(c).cast("double"))
        if digits is not None:
            r = F.round(r, digits)
        aggs.append(r.alias(f"c{i}"))
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as ({name_col}, {value_col})")
