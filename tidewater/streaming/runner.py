"""Start, drive and stop streaming queries.

Every query gets its own checkpoint folder under the shared checkpoint
directory (so a restarted driver resumes where it stopped) and a unique
name, and is stopped in ``finally``.  ``availableNow`` processes what is
there in as many micro-batches as the source limits allow, then ends;
``processing_time`` gives the reference's fixed batch interval.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pyspark.sql.types import LongType, StructField, StructType

from tidewater.session import scratch_path

_START_LOCK = threading.Lock()

#: Settings of a query whose state has timers or lists; also the choice for any large state.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def trigger_options(processing_time: str | None = None, available_now: bool = True) -> dict:
    """``trigger(**opts)`` arguments: a fixed interval, or run-available-then-stop."""
    if processing_time:
        return {"processingTime": processing_time}
    return {"availableNow": True} if available_now else {}


def start(writer: DataStreamWriter, spark: SparkSession, name: str,
          processing_time: str | None = None, checkpoint: str | None = None,
          state_partitions: int | None = None, settings: dict[str, str] | None = None) -> StreamingQuery:
    """Start with its own checkpoint folder and a unique name.

    ``state_partitions`` fixes the number of state-store partitions of the
    query's stateful operators.  Spark reads it once, when the query first
    starts, and keeps it in the checkpoint (AQE does not re-plan streams), so
    choose it for the peak state size; by default the session's
    ``spark.sql.shuffle.partitions`` applies.  ``settings`` hold for this query
    alone, e.g. :data:`ROCKSDB`.
    """
    ckpt = checkpoint or scratch_path(spark, f"stream-{name}")
    w = writer.queryName(f"{name}_{uuid.uuid4().hex[:8]}").option("checkpointLocation", ckpt)
    trig = trigger_options(processing_time)
    if trig:
        w = w.trigger(**trig)
    own = dict(settings or {})
    if state_partitions:
        own["spark.sql.shuffle.partitions"] = str(state_partitions)
    if not own:
        return w.start()
    # The query copies the settings of the frame's session when it starts.  Other
    # queries of a shared session must not see the change: take the lock, put it back.
    conf = writer._spark.conf
    with _START_LOCK:
        previous = {key: conf.get(key, None) for key in own}
        try:
            for key, value in own.items():
                conf.set(key, value)
            return w.start()
        finally:
            for key, value in previous.items():
                conf.unset(key) if value is None else conf.set(key, value)


def run_until_done(writer: DataStreamWriter, spark: SparkSession, name: str,
                   timeout_s: float | None = None, checkpoint: str | None = None,
                   state_partitions: int | None = None, settings: dict[str, str] | None = None) -> None:
    """Run an ``availableNow`` query to its end; re-raise its failure."""
    q = start(writer, spark, name, checkpoint=checkpoint, state_partitions=state_partitions, settings=settings)
    try:
        q.awaitTermination(timeout_s)
        err = q.exception()
        if err is not None:
            raise RuntimeError(f"streaming query {name} failed: {err}")
    finally:
        q.stop()


def run_on_interval(writer: DataStreamWriter, spark: SparkSession, name: str,
                    processing_time: str = "1 second", checkpoint: str | None = None,
                    state_partitions: int | None = None) -> None:
    """Run with a fixed micro-batch interval until everything available so
    far has been processed, then stop (a running service would instead
    ``awaitTermination()``)."""
    q = start(writer, spark, name, processing_time=processing_time, checkpoint=checkpoint,
              state_partitions=state_partitions)
    try:
        q.processAllAvailable()
        err = q.exception()
        if err is not None:
            raise RuntimeError(f"streaming query {name} failed: {err}")
    finally:
        q.stop()


def default_state_partitions(spark: SparkSession) -> int:
    """State-store partitions of a stream that states none: one per core of the cluster."""
    return max(1, spark.sparkContext.defaultParallelism)


def run_with_restarts(make_writer: Callable[[], DataStreamWriter], spark: SparkSession, name: str,
                      checkpoint: str, restarts: int = 3, state_partitions: int | None = None) -> int:
    """Run an ``availableNow`` query to its end, starting it again on the same checkpoint when it fails.

    A restarted query takes up the batch that was not committed, with the same
    input and the state before it; the sink must be idempotent per batch
    (``versioned_writer`` is).  ``make_writer`` builds the query anew for each
    start.  Returns the number of restarts; the last failure is raised.
    """
    for attempt in range(restarts + 1):
        try:
            run_until_done(make_writer(), spark, name, checkpoint=checkpoint, state_partitions=state_partitions)
            return attempt
        except (RuntimeError, StreamingQueryException):
            if attempt == restarts:
                raise
    return restarts


def versioned_writer(df: DataFrame, path: str, output_mode: str = "update", batch_col: str = "batch_id",
                     each=None, keys: list[str] | None = None, compact_every: int = 0) -> DataStreamWriter:
    """``foreachBatch`` sink: each micro-batch's rows go to ``<path>/<batch_col>=<id>``.

    ``each`` maps a micro-batch's rows before they are written.  A batch
    replayed after a failure overwrites its own folder, so the sink is
    idempotent; :func:`latest_versions` keeps the newest row per key.  With
    ``keys`` and ``compact_every`` = n, every n-th batch first merges the
    committed versions before it into one (:func:`compact_versions`), so a
    reader meets at most n + 1 versions however long the stream runs.
    """
    schema = df.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        if keys and compact_every and batch_id and batch_id % compact_every == 0:
            compact_versions(batch.sparkSession, path, keys, schema, batch_id - 1, batch_col)
        write_version(each(batch) if each else batch, batch_id, path, batch_col)

    return df.writeStream.outputMode(output_mode).foreachBatch(write)


def _folders(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    """Number -> folder of the complete ``<prefix><number>`` folders below a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return {}
    found = {}
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(prefix) and fs.exists(done):
            found[int(name.removeprefix(prefix))] = status.getPath().toString()
    return found


def versions(spark: SparkSession, path: str, batch_col: str = "batch_id") -> tuple[dict[int, str], dict[int, str]]:
    """The folders a reader needs: (the newest merged one, the batches after it), by number."""
    merged = _folders(spark, f"{path}/merged", "upto=")
    newest = max(merged, default=-1)
    batches = {k: v for k, v in _folders(spark, path, f"{batch_col}=").items() if k > newest}
    return ({newest: merged[newest]} if merged else {}), batches


def compact_versions(spark: SparkSession, path: str, keys: list[str], schema: StructType, upto: int,
                     batch_col: str = "batch_id") -> None:
    """Merge all versions up to batch ``upto`` into one that holds the newest row per key.

    The merged version counts once its files are complete; from then on the
    older folders are ignored and removed.  A run that was cut off at any
    point can be repeated: what is left of it is unread or written again.
    """
    merged, batches = versions(spark, path, batch_col)
    old = {**merged, **{k: v for k, v in batches.items() if k <= upto}}
    if not any(k in old for k in batches):
        return
    rows = latest_versions(spark, path, keys, schema, batch_col, upto)
    rows.write.mode("overwrite").parquet(f"{path}/merged/upto={upto}")
    for folder in [v for k, v in old.items() if v != f"{path}/merged/upto={upto}"]:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_version(batch: DataFrame, batch_id: int, path: str, batch_col: str = "batch_id") -> None:
    """Write one micro-batch's rows; writing the same id again replaces them."""
    batch.write.mode("overwrite").parquet(f"{path}/{batch_col}={batch_id}")


def _versions(spark: SparkSession, path: str, schema: StructType, batch_col: str, upto: int | None = None) -> DataFrame:
    """The sink's rows with their batch id; none if no micro-batch was ever written."""
    full = StructType([*schema.fields, StructField(batch_col, LongType())])
    merged, batches = versions(spark, path, batch_col)
    batches = [v for k, v in sorted(batches.items()) if upto is None or k <= upto]
    rows = spark.createDataFrame([], full)
    if batches:                                   # one scan; the batch id is the folder's name
        rows = spark.read.schema(full).option("basePath", path).parquet(*batches)
    for number, folder in merged.items():
        rows = rows.unionByName(spark.read.schema(schema).parquet(folder).withColumn(batch_col, F.lit(number).cast("long")))
    return rows


def latest_versions(spark: SparkSession, path: str, keys: list[str], schema: StructType,
                    batch_col: str = "batch_id", upto: int | None = None) -> DataFrame:
    """Newest row per key from a versioned sink (update / complete modes), in one
    aggregation; an empty frame of ``schema`` if the stream had no data.  ``upto``: only
    versions up to that batch."""
    rows = _versions(spark, path, schema, batch_col, upto)
    values = [c for c in schema.names if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(batch_col)).alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def newest_batch(spark: SparkSession, path: str, schema: StructType, batch_col: str = "batch_id") -> DataFrame:
    """The rows of the last micro-batch (complete mode: the whole result)."""
    rows = _versions(spark, path, schema, batch_col)
    last = rows.agg(F.max(batch_col)).head()[0]
    return rows.where(F.col(batch_col) == F.lit(last)).drop(batch_col)
