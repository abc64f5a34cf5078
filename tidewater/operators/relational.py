"""Joins, grouping, distinct, ordering and top-k.

All operators are DataFrame -> DataFrame and lazy: no job runs while a plan is
built.  Joins carry no hints; Spark picks broadcast, hash or sort-merge from
its own byte estimates and, with AQE, from measured shuffle sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

def _cols(cols) -> list:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def lookup(fact: DataFrame, dim: DataFrame, on, how: str = "left", strict: bool = False) -> DataFrame:
    """id -> attributes from a dimension.

    ``how="left"`` keeps fact rows whose id is missing (null attributes).
    ``strict=True`` raises instead, like a dictionary lookup would; the check
    is one anti-join count, run when ``lookup`` is called.
    """
    if strict:
        keys = _cols(on)
        if not fact.select(*keys).join(dim.select(*keys), keys, "left_anti").isEmpty():
            raise KeyError(f"lookup: ids missing from the dimension on {keys}")
    return fact.join(dim, on, how)


def inner_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Inner equi-join; Catalyst/AQE choose broadcast, shuffle-hash or sort-merge."""
    return left.join(right, on, "inner")


def count_by(df: DataFrame, keys, name: str = "count") -> DataFrame:
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys, value, name: str) -> DataFrame:
    return df.groupBy(*_cols(keys)).agg(F.sum(value).alias(name))


def sum_count_by(df: DataFrame, keys, value, sum_name: str = "total",
                 count_name: str = "count") -> DataFrame:
    """(sum, count) in one pass; map-side partial aggregation is automatic."""
    return df.groupBy(*_cols(keys)).agg(F.sum(value).alias(sum_name),
                                        F.count(F.lit(1)).alias(count_name))


def avg_by(df: DataFrame, keys, value, name: str) -> DataFrame:
    return df.groupBy(*_cols(keys)).agg(F.avg(value).alias(name))


def mean_and_count_by(df: DataFrame, keys, value, mean_name: str = "mean",
                      count_name: str = "count") -> DataFrame:
    """Mean and count from one aggregate (not two aggregates joined back)."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(count_name),
                                        F.avg(value).alias(mean_name))


def having(df: DataFrame, condition) -> DataFrame:
    return df.filter(condition)


def max_mean_by(df: DataFrame, keys, value, max_name: str = "max", mean_name: str = "mean") -> DataFrame:
    return df.groupBy(*_cols(keys)).agg(F.max(value).alias(max_name), F.avg(value).alias(mean_name))


def mean_stddev_by(df: DataFrame, keys, value, digits: int | None = 2,
                   mean_name: str = "avg", std_name: str = "std_dev") -> DataFrame:
    """Mean and *sample* standard deviation (null for a one-row group)."""
    m, s = F.avg(value), F.stddev_samp(value)
    if digits is not None:
        m, s = F.round(m, digits), F.round(s, digits)
    return df.groupBy(*_cols(keys)).agg(m.alias(mean_name), s.alias(std_name))


def distinct_rows(df: DataFrame, cols=None) -> DataFrame:
    cols = _cols(cols)
    return (df.select(*cols) if cols else df).distinct()


def distinct_sorted(df: DataFrame, col: str, descending: bool = True) -> DataFrame:
    d = df.select(col).distinct()
    return d.orderBy(F.col(col).desc() if descending else F.col(col).asc())


def global_sum(df: DataFrame, col, name: str = "total") -> DataFrame:
    return df.agg(F.sum(col).alias(name))


def sort_by(df: DataFrame, cols, descending: bool = False) -> DataFrame:
    cs = [F.col(c) if isinstance(c, str) else c for c in _cols(cols)]
    return df.orderBy(*[c.desc() if descending else c.asc() for c in cs])


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First k rows of a total order; ``orderBy.limit`` plans TakeOrderedAndProject
    (per-partition top-k, no full sort)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group_cols, order: Sequence[Column], k: int,
                    rank_name: str = "rank") -> DataFrame:
    """k first rows per group by ``row_number``.

    Spark plans a partial WindowGroupLimit before the shuffle, so each map
    task ships at most k rows per group: a hot group cannot swamp one task.
    """
    w = Window.partitionBy(*_cols(group_cols)).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= k)


def ratio_of_counts(child_counts: DataFrame, parent_counts: DataFrame, parent_key,
                    child_count: str, parent_count: str, name: str = "share") -> DataFrame:
    """Each group's count divided by the total of its parent group."""
    j = child_counts.join(parent_counts, parent_key, "inner")
    return j.withColumn(name, F.col(child_count).cast("double") / F.col(parent_count).cast("double"))


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """null -> 0 on the named columns, names and positions kept."""
    return df.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def store_bucketed(df: DataFrame, keys: list[str], buckets: int, table: str) -> DataFrame:
    """``df`` stored as table ``table``, hashed and sorted by ``keys`` into ``buckets`` files.

    Two tables stored so, with the same keys and number of buckets, join
    bucket to bucket: neither side is shuffled again, however often they meet.
    The files go to the shared folder and are removed when the driver ends.
    """
    from tidewater.session import remove_at_exit, scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, table)
    # one writer per bucket, else every task would write a file into every bucket
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    remove_at_exit(spark, path)
    return spark.table(table)
