"""Pivots: rows x pivot values, one or several measures per cell.

Two plans for the same result:

* ``pivot_agg`` with measures given as ``(function, column)`` specs builds
  one conditional aggregate per cell, ``fn(when(pivot = v, column))``,
  guarded by a presence count so a (group, value) pair without rows gives
  null exactly as ``pivot`` does.  One aggregation, one shuffle (partial
  aggregates map-side), for any bounded value list.
* with measures given as Columns it uses Spark's ``pivot`` (two
  aggregations: per (group, value), then per group).

With ``values=None`` and spec measures, the input is aggregated once per
(group, value) and written to the shared folder; the values are read off that
small table and Spark's ``pivot`` turns its cells into columns: one pass over
the input instead of a discovery pass plus an aggregation pass.  Every value
becomes a column, however many there are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import written

MeasureSpec = tuple[Callable[[Column], Column], "Column | str"]


def discover_values(df: DataFrame, pivot_col: str) -> list:
    """Sorted distinct values of ``pivot_col`` (nulls first): the result's column names."""
    return [r[0] for r in df.select(pivot_col).distinct()
            .orderBy(F.col(pivot_col).asc_nulls_first()).collect()]


def _cell_name(value, measure: str | None) -> str:
    v = "null" if value is None else str(value)
    return v if not measure else f"{v}_{measure}"


def pivot_conditional(df: DataFrame, group_cols, pivot_col: str, values: Sequence,
                      measures: dict[str, MeasureSpec]) -> DataFrame:
    """One aggregate with a conditional cell per (value, measure)."""
    groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    p = F.col(pivot_col)
    single = len(measures) == 1
    cells = []
    for v in values:
        cond = p.isNull() if v is None else (p == F.lit(v))
        present = F.count(F.when(cond, F.lit(1))) > 0
        for name, (fn, col) in measures.items():
            c = F.col(col) if isinstance(col, str) else col
            cell = F.when(present, fn(F.when(cond, c)))
            cells.append(cell.alias(_cell_name(v, None if single else name)))
    return df.groupBy(*groups).agg(*cells)


def pivot_discovered(df: DataFrame, group_cols, pivot_col: str,
                     measures: dict[str, MeasureSpec]) -> DataFrame:
    """Pivot whose values are not known: one pass over the input.

    The input is aggregated once per (group, value) -- each row of that result
    already *is* a final cell -- and the result is written to the session's
    shared folder.  The values are the distinct ones of that table, and its
    cells are pivoted with the value list given, one ``first`` per measure.
    """
    groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    names = list(measures)
    cells = written(df.groupBy(*groups, pivot_col).agg(
        *[fn(F.col(col) if isinstance(col, str) else col).alias(c)
          for c, (fn, col) in measures.items()]), "pivot")
    values = discover_values(cells, pivot_col)
    # pivot matches values with =, which null never passes: its cells are joined by a flag of their own
    known = [v for v in values if v is not None]
    firsts = [F.first(c).alias(c) for c in names]
    out = cells.groupBy(*groups).pivot(pivot_col, known).agg(*firsts) if known else cells.select(*groups).distinct()
    if len(known) < len(values):
        null_cells = cells.where(F.col(pivot_col).isNull()).select(
            *groups, *[F.col(c).alias(_cell_name(None, None if len(names) == 1 else c)) for c in names])
        same = [F.col(f"o.{g}").eqNullSafe(F.col(f"n.{g}")) for g in groups]
        out = out.alias("o").join(null_cells.alias("n"), same, "left").select(
            *[F.col(f"o.{g}").alias(g) for g in groups],
            *[F.col(f"n.`{c}`") for c in null_cells.columns[len(groups):]],
            *[F.col(f"o.`{c}`") for c in out.columns[len(groups):]])
    return out


def pivot_agg(df: DataFrame, group_cols, pivot_col: str,
              measures: dict[str, MeasureSpec] | dict[str, Column] | Column,
              values: Sequence | None = None) -> DataFrame:
    """``groupBy(group_cols).pivot(pivot_col, values).agg(...)``.

    Cells are named ``<value>_<measure>`` (``<value>`` for a single measure).
    """
    specs = isinstance(measures, dict) and all(isinstance(m, tuple) for m in measures.values())
    if specs:
        if values is None:
            return pivot_discovered(df, group_cols, pivot_col, measures)
        return pivot_conditional(df, group_cols, pivot_col, values, measures)
    if values is None:
        values = discover_values(df, pivot_col)
    groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    p = df.groupBy(*groups).pivot(pivot_col, list(values))
    if isinstance(measures, Column):
        return p.agg(measures)
    return p.agg(*[m.alias(name) for name, m in measures.items()])


def sparse_pivot(df: DataFrame, group: str, item: str, measure: Column) -> DataFrame:
    """``group`` and ``cells``: its (item, value) pairs sorted by item, null first.

    The pivot for columns of many values: a group holds the items it has, not
    a column per item of the table, and the list of items is never needed.
    One shuffle of (group, item) cells, one of the lists; a hot group moves
    one row per item it has.
    """
    cells = df.groupBy(group, item).agg(measure.alias("value"))
    pair = F.struct(F.col(item).alias("item"), "value")
    return cells.groupBy(group).agg(F.sort_array(F.collect_list(pair)).alias("cells"))
