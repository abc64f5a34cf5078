"""Feature preparation with Spark ML transformers.

Fitting a ``StringIndexer`` is one distributed aggregation; only the label
list (one entry per distinct value) comes back to the driver, so index
columns of bounded cardinality.  Vectors are produced by the JVM
transformers; ``vector_elements`` turns them back into scalar columns for
output and comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import written


def string_indexer(input_cols: Sequence[str], output_cols: Sequence[str],
                   handle_invalid: str = "error",
                   order: str = "frequencyDesc") -> StringIndexer:
    """Most frequent value -> 0.0; equal counts are ordered alphabetically.

    ``handle_invalid="keep"`` gives unseen values their own last index
    instead of failing (useful when indexers are fitted on a training split).
    """
    return StringIndexer(inputCols=list(input_cols), outputCols=list(output_cols),
                         handleInvalid=handle_invalid, stringOrderType=order)


def index_strings(df: DataFrame, mapping: dict[str, str], handle_invalid: str = "error",
                  order: str = "frequencyDesc") -> tuple[DataFrame, object]:
    """Fit and apply one indexer for several columns; returns (frame, model)."""
    model = string_indexer(list(mapping), list(mapping.values()), handle_invalid, order).fit(df)
    return model.transform(df), model


def index_to_string(df: DataFrame, input_col: str, output_col: str,
                    labels: Sequence[str] | None = None) -> DataFrame:
    """Index -> original value, from the index column's metadata or ``labels``."""
    t = IndexToString(inputCol=input_col, outputCol=output_col)
    if labels is not None:
        t.setLabels(list(labels))
    return t.transform(df)


def one_hot(df: DataFrame, input_cols: Sequence[str], output_cols: Sequence[str],
            drop_last: bool = True, handle_invalid: str = "error") -> DataFrame:
    """Index -> sparse 0/1 vector (the last category dropped by default)."""
    enc = OneHotEncoder(inputCols=list(input_cols), outputCols=list(output_cols),
                        dropLast=drop_last, handleInvalid=handle_invalid)
    return enc.fit(df).transform(df)


def assembler(input_cols: Sequence[str], output_col: str = "features",
              handle_invalid: str = "error", label: str | None = "label") -> VectorAssembler:
    """Columns -> one vector, in the given order.

    Refuses to put the label among the features (target leakage).
    """
    if label is not None and label in input_cols:
        raise ValueError(f"label column {label!r} must not be a feature")
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col,
                           handleInvalid=handle_invalid)


def assemble(df: DataFrame, input_cols: Sequence[str], output_col: str = "features",
             handle_invalid: str = "error", label: str | None = "label") -> DataFrame:
    return assembler(input_cols, output_col, handle_invalid, label).transform(df)


def vector_elements(df: DataFrame, vector_col: str, n: int, prefix: str,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Vector -> ``prefix0 .. prefix{n-1}`` double columns."""
    arr = vector_to_array(F.col(vector_col))
    return df.select(*keep, *[arr.getItem(i).alias(f"{prefix}{i}") for i in range(n)])


def array_column_to_vector(df: DataFrame, array_col: str, output_col: str = "features") -> DataFrame:
    """array<float|double> -> ML dense vector (JVM-side)."""
    return df.withColumn(output_col, array_to_vector(F.col(array_col).cast("array<double>")))


# Fixed values of the split's key arithmetic: a prime modulus and two multipliers,
# small enough that no product leaves 64 bits.
SPLIT_PRIME, SPLIT_A, SPLIT_B = 2147483647, 48271, 69621


def split_point_sql(keys: Sequence[str], seed: int = 42) -> str:
    """A number in [0, 1) that depends on integer keys alone, as SQL that any engine runs."""
    v = str(seed % SPLIT_PRIME)
    for k in keys:
        key = f"((cast({k} as bigint) % {SPLIT_PRIME} + {SPLIT_PRIME}) % {SPLIT_PRIME})"
        v = f"((({v}) * cast({SPLIT_B} as bigint) + {key} * {SPLIT_A} + 12345) % {SPLIT_PRIME})"
        v = f"((({v}) * cast(16807 as bigint) + 7) % {SPLIT_PRIME})"
    return f"(cast({v} as double) / {SPLIT_PRIME}.0)"


def seeded_split(df: DataFrame, weights: Sequence[float], keys: Sequence[str] | str,
                 seed: int = 42) -> list[DataFrame]:
    """Disjoint parts of about the given weights, chosen by a hash of the row's key.

    A row's part depends on its key and the seed only, never on how the rows
    are partitioned or cached, so the parts cannot overlap or lose rows when
    they are read at different times.  Rows with equal keys stay together.
    Keys that are not integers count by their 64-bit hash, null keys as 0.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    kinds = dict(df.dtypes)
    ints = ("tinyint", "smallint", "int", "bigint")
    # the helper columns are dropped again with the split point
    hashed = {f"_key{i}": F.coalesce(F.col(k).cast("bigint") if kinds[k] in ints else F.xxhash64(k), F.lit(0))
              for i, k in enumerate(keys)}
    at = F.expr(split_point_sql(list(hashed), seed))
    tagged = df.withColumns(hashed).withColumn("_split", at).drop(*hashed)
    total, low, parts = float(sum(weights)), 0.0, []
    for i, w in enumerate(weights):
        high = 2.0 if i == len(weights) - 1 else low + w / total
        parts.append(tagged.where((F.col("_split") >= low) & (F.col("_split") < high)).drop("_split"))
        low = high
    return parts


def dense_ids(df: DataFrame, col: str, name: str) -> DataFrame:
    """(col, name): the distinct non-null values and a number from 0 without gaps, as int.

    Numbers follow the values' order: ranges of values are numbered apart and
    shifted by the sizes of the ranges before them (one row per range).
    """
    part = df.select(col).where(F.col(col).isNotNull()).distinct().repartitionByRange(col).sortWithinPartitions(col)
    part = written(part.select(col, F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i")),
                   "dense-ids")
    starts, at = [], 0
    for p, n in sorted(tuple(r) for r in part.groupBy("_p").count().collect()):
        starts.append((p, at))
        at += n
    if at > 2**31 - 1:
        raise ValueError(f"{at} distinct values of {col}: more than an int can number")
    starts = df.sparkSession.createDataFrame(starts, "_p int, _start bigint")
    place = F.col("_start") + F.col("_i").bitwiseAND((1 << 33) - 1)
    return part.join(F.broadcast(starts), "_p").select(col, place.cast("int").alias(name))


def split_check(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """One row (total, overlap): rows over all parts and keys found in more
    than one part, in a single aggregation (no join of the parts)."""
    tagged = None
    for i, p in enumerate(parts):
        t = p.select(key, F.lit(i).alias("_part"))
        tagged = t if tagged is None else tagged.unionByName(t)
    per_key = tagged.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                      F.min("_part").alias("_lo"), F.max("_part").alias("_hi"))
    return per_key.agg(F.sum("_n").alias("total"),
                       F.sum(F.when(F.col("_lo") != F.col("_hi"), 1).otherwise(0))
                       .cast("long").alias("overlap"))


def index_by_frequency(df: DataFrame, column: str, output: str) -> DataFrame:
    """``df`` with the rank of ``column``'s value: most frequent 0.0, equal counts by value; null stays null.

    For columns of any number of values: no label list reaches the driver.
    The distinct values are dealt by range of (count descending, value), each
    range numbers its own, and only the ranges' sizes are collected; the ranks
    come back by a join on the value.
    """
    from pyspark.sql import Window

    from tidewater.session import written

    order = [F.col("_n").desc(), F.col("_v")]
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    dealt = written(values.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "_v", "_n", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "value-ranks")
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))           # one row per range
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    ranks = dealt.join(F.broadcast(before), "_part").select(
        "_v", (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).cast("double").alias(output))
    return df.join(ranks, df[column] == ranks["_v"], "left").drop("_v")
