"""Small helpers that the training-data operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.session import checkpoint_root, remove_at_exit

#: A word is a maximal run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
LOWER_FROM, LOWER_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, in order; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """The whole row as one column ``_row`` beside the named columns.

    An operator's own columns then clash with none of the input's; the rows
    come back with ``select("_row.*")``.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    return df.select(row, *[c.alias(name) for name, c in more.items()])


def row_hash(df: DataFrame) -> Column:
    """64-bit content hash of a whole row: equal rows have equal hashes."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back.

    Cuts the lineage: an executor lost later costs no recomputation of what
    was written, and non-deterministic columns keep the values written.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    void = {c: F.col(f"`{c}`").cast("string") for c, kind in df.dtypes if kind == "void"}
    (df.withColumns(void) if void else df).write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.withColumns(void).schema if void else df.schema).parquet(path)


def is_scan(df: DataFrame) -> bool:
    """True if ``df`` only filters and projects a source: every read deals its rows to the same tasks."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        below = node.children()
        if below.size() and node.nodeName() not in ("Project", "Filter"):
            return False
        todo += [below.apply(i) for i in range(below.size())]
    return True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def feistel(x: Column, n: Column, key: Column, rounds: int = 4) -> Column:
    """Pseudorandom permutation of 0..n-1, by a Feistel network with cycle walking.

    ``x`` is split over the grid ``a * b >= n`` with ``a = ceil(sqrt(n))`` and
    ``b = ceil(n / a)``; each round adds a keyed hash of one half to the other,
    modulo that half's size, so every round is a bijection of the grid.  Less
    than one value in ``sqrt(n)`` falls outside 0..n-1; those walk on along
    their cycle.  A walk meets each outside value at most once, so 64 steps
    are exact below n = 4096 and miss with a chance under 64**-64 above; a
    miss raises an error rather than return a wrong number.
    """
    a = F.greatest(F.ceil(F.sqrt(n)).cast("long"), F.lit(1).cast("long"))
    b = F.greatest(F.ceil(n / a).cast("long"), F.lit(1).cast("long"))

    def once(v: Column) -> Column:
        right = F.pmod(v, b)
        start = F.struct(((v - right) / b).cast("long").alias("l"), right.alias("r"))

        def turn(s: Column, i: Column) -> Column:
            left = F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], i, key), a), a)
            return F.struct(left.alias("l"),
                            F.pmod(s["r"] + F.pmod(F.xxhash64(left, i + 100, key), b), b).alias("r"))

        return F.aggregate(F.array(*[F.lit(i) for i in range(rounds)]), start, turn,
                           lambda s: s["l"] * b + s["r"])

    def walk(v: Column) -> Column:
        end = F.aggregate(F.sequence(F.lit(1), F.lit(64)), v,
                          lambda y, _: F.when(y < n, y).otherwise(once(y)))
        return F.when(end < n, end).otherwise(
            F.raise_error(F.lit("cycle walk left 64 steps behind")).cast("long"))

    # the walk is only entered by values outside 0..n-1
    return F.aggregate(F.array(once(x)), F.lit(0).cast("long"),
                       lambda _, y: F.when(y < n, y).otherwise(walk(y)))


def numbered(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """(``df`` with its rank ``_rank`` from 0 in ``order``, the number of rows).

    Rows are dealt by range, so a run of equal keys is split by the scan
    position added behind them: a key that holds a third of all rows is no
    hot task.  Rows are then numbered inside their range; the ranges' sizes
    (one row per range) give the offsets.  The ranges are written before they
    are counted, so both steps see the same ones.
    """
    dealt = df.withColumn("_tie", F.monotonically_increasing_id())
    order = [*order, F.col("_tie")]
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    dealt = dealt.select("*", F.spark_partition_id().alias("_part"),
                         F.monotonically_increasing_id().alias("_at"))
    dealt = stored(dealt, name)
    sizes = sorted(dealt.groupBy("_part").agg(F.count("*").alias("n")).collect())
    total, starts = 0, []                       # one entry per range of the shuffle
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _start long")
    # monotonically_increasing_id() is the partition's number * 2**33 + the place in it
    out = dealt.join(F.broadcast(offsets), "_part").withColumn(
        "_rank", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
    return out.drop("_part", "_at", "_start"), total


def streamed_sha256(pieces: DataFrame, key: str, order: str, text: str, sep: str) -> DataFrame:
    """(key, sha256): the digest of each key's texts in ``order``, joined by ``sep``.

    A digest reads its input in order, so a key is one task's work; rows are
    hashed as they stream by and no key is ever held whole.  ``key`` has no nulls.
    """
    kind = pieces.schema[key].dataType.simpleString()
    glue = sep.encode()

    def run(batches):
        import hashlib

        import pyarrow as pa

        now, digest = None, None
        for batch in batches:
            keys, hashes = [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                if digest is None or k != now:
                    if digest is not None:
                        keys.append(now)
                        hashes.append(digest.hexdigest())
                    now, digest = k, hashlib.sha256(t.as_py().encode())
                else:
                    digest.update(glue)
                    digest.update(t.as_py().encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), pa.array(hashes, pa.string())],
                                                 names=[key, "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.column(0).type),
                                              pa.array([digest.hexdigest()], pa.string())], names=[key, "sha256"])

    dealt = pieces.repartition(key).sortWithinPartitions(key, order).select(key, text)
    return dealt.mapInArrow(run, f"`{key}` {kind}, sha256 string")
