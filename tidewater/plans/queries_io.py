"""Test queries for sources (2.1) and streams (2.6).

Round-trip queries write a driver table to a fresh folder under the shared
checkpoint directory, then read it back with the reader under test.
Streaming queries replay ``events.parquet`` through the file source with an
``availableNow`` trigger and read the sink's newest version per key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.plans import queries_core  # noqa: F401  (registers the batch oracles reused here)
from tidewater.plans.registry import ORACLES, half_up, register
from tidewater.session import remove_at_exit, scratch_path
from tidewater.sources import text as S
from tidewater.operators.windows import sliding_from_buckets
from tidewater.functions.columns import ntz_to_instant
from tidewater.sources.streams import delivered_once, file_stream
from tidewater.sources.tables import SCHEMAS, Tables, table_path
from tidewater.streaming import jobs as SJ
from tidewater.streaming.arrival import arrival_windows
from tidewater.streaming.runner import (ROCKSDB, default_state_partitions, latest_versions, newest_batch,
                                        run_on_interval, run_until_done, run_with_restarts,
                                        versioned_writer, write_version)

# --------------------------------------------------------------------------
# 2.1 sources
# --------------------------------------------------------------------------


@register("csv_strings", """
select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
       o_orderstatus, o_orderpriority
from orders""")
def q_csv_strings(spark, sf):
    path = scratch_path(spark, "csv-strings")
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                                        "o_orderpriority")
    S.write_csv(o, path)
    remove_at_exit(spark, path)
    return S.read_csv_strings(spark, path)


@register("csv_inferred", """
select cast(c_custkey as integer) as c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
from customer""")
def q_csv_inferred(spark, sf):
    path = scratch_path(spark, "csv-inferred")
    S.write_csv(Tables(spark, sf).customer, path)
    remove_at_exit(spark, path)
    return S.read_csv_inferred(spark, path)


SUPPLIER_SCHEMA = T.StructType([
    T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
    T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())])


@register("csv_glob", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def q_csv_glob(spark, sf):
    path = scratch_path(spark, "csv-glob")
    # several part files at any size, as many as the scan has tasks
    S.write_csv(Tables(spark, sf).supplier, path)
    remove_at_exit(spark, path)
    return S.read_csv_typed(spark, f"{path}/part-*.csv", SUPPLIER_SCHEMA)


@register("text_delimited", "select o_orderkey, o_custkey, o_orderstatus from orders")
def q_text_delimited(spark, sf):
    path = scratch_path(spark, "text-delimited")
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                                        "o_orderpriority")
    S.write_lines(o, path, ",")
    remove_at_exit(spark, path)
    return S.read_delimited(spark, path, [("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                                          ("o_orderstatus", "string")])


@register("text_whitespace", "select l_partkey as item, l_quantity as rating from lineitem")
def q_text_whitespace(spark, sf):
    path = scratch_path(spark, "text-whitespace")
    li = Tables(spark, sf).lineitem
    lines = li.select(F.concat(F.col("l_orderkey").cast("string"), F.lit(" \t"),
                               F.col("l_partkey").cast("string"), F.lit("  "),
                               F.col("l_quantity").cast("string"), F.lit("\t"),
                               F.unix_timestamp("l_shipdate").cast("string")).alias("value"))
    lines.write.text(path)
    remove_at_exit(spark, path)
    return S.read_whitespace(spark, path, [(1, "item", "bigint"), (2, "rating", "double")])


@register("text_pipe_lookup", "select p_partkey as item, p_name as name from part")
def q_text_pipe_lookup(spark, sf):
    path = scratch_path(spark, "text-pipe")
    S.write_lines(Tables(spark, sf).part.select("p_partkey", "p_name", "p_brand"), path, "|")
    remove_at_exit(spark, path)
    return S.read_pipe_lookup(spark, path)


# Order status codes and their names, as in-memory rows.
_STATUS_ROWS = (("F", "fulfilled"), ("O", "open"), ("P", "partial"))
_STATUS_SCHEMA = T.StructType([T.StructField("o_orderstatus", T.StringType(), False),
                               T.StructField("status_name", T.StringType(), False)])


@register("inline_rows", """
select s.status_name, count(*) as n_orders
from orders o join (values ('F', 'fulfilled'), ('O', 'open'), ('P', 'partial'))
     s(o_orderstatus, status_name) on o.o_orderstatus = s.o_orderstatus
group by 1""")
def q_inline_rows(spark, sf):
    names = S.inline_rows(spark, _STATUS_ROWS, _STATUS_SCHEMA)
    o = Tables(spark, sf).orders.select("o_orderstatus")
    # three literal rows: broadcast size is bounded by construction
    return (o.join(F.broadcast(names), "o_orderstatus")
            .groupBy("status_name").agg(F.count(F.lit(1)).alias("n_orders")))


@register("temp_view_sql", f"""
select o_orderpriority, count(*) as n_orders, {half_up("sum(o_totalprice)", 2)} as revenue
from orders group by 1""")
def q_temp_view_sql(spark, sf):
    view = f"tw_orders_{uuid.uuid4().hex[:8]}"
    Tables(spark, sf).orders.createOrReplaceTempView(view)
    return spark.sql(f"""
        select o_orderpriority, count(*) as n_orders, round(sum(o_totalprice), 2) as revenue
        from {view} group by o_orderpriority""")


# --------------------------------------------------------------------------
# 2.6 streams (file source replaying events.parquet)
# --------------------------------------------------------------------------

FILES_PER_TRIGGER = 64


def replay_watermark(spark, sf, margin_minutes: int = 1) -> str:
    """How late an event of a replayed table may come: its whole span, read off the table.

    The files of a table are in no order of time, so an event may arrive after
    any other; a watermark of the span drops none.  (A live stream states the
    lateness it allows instead.)
    """
    lo, hi = Tables(spark, sf).events.agg(F.min("ts"), F.max("ts")).head()
    minutes = int((hi - lo).total_seconds() // 60) if lo is not None else 0
    return f"{minutes + margin_minutes} minutes"


def events_stream(spark, sf, max_files_per_trigger=FILES_PER_TRIGGER):
    schema = T.StructType.fromDDL(SCHEMAS["events"])
    return file_stream(spark, table_path(sf, "events"), schema, max_files_per_trigger=max_files_per_trigger)


def _run_versioned(spark, df, name, keys, output_mode="update"):
    out = scratch_path(spark, f"sink-{name}")
    run_until_done(versioned_writer(df, out, output_mode), spark, name, state_partitions=default_state_partitions(spark))
    remove_at_exit(spark, out)
    return latest_versions(spark, out, keys, df.schema)


@register("stream_file_source", """
select event_type, count(*) as n from events group by 1""")
def q_stream_file_source(spark, sf):
    counts = events_stream(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return _run_versioned(spark, counts, "file-source", ["event_type"], "complete")


@register("stream_tumbling_update", ORACLES["tumbling_event_window"])
def q_stream_tumbling_update(spark, sf):
    agg = SJ.seconds_per_course(events_stream(spark, sf), "ts", "event_type", "2 minutes", watermark=replay_watermark(spark, sf))
    return _run_versioned(spark, agg, "tumbling", ["window_start", "window_end", "course_name"])


@register("stream_sliding_sum", ORACLES["sliding_window_60m_1m"])
def q_stream_sliding_sum(spark, sf):
    """The stream keeps tumbling 1-minute sums per course (state: one row per
    bucket and course, one update per event); the 60-minute windows every
    minute are built from that bucket table, not by copying each event into
    60 windows of streaming state."""
    buckets = SJ.seconds_per_course(events_stream(spark, sf), "ts", "event_type", "1 minute",
                                    watermark=replay_watermark(spark, sf))
    latest = _run_versioned(spark, buckets, "sliding-buckets",
                            ["window_start", "window_end", "course_name"])
    return sliding_from_buckets(latest, "window_start", "course_name", "60 minutes", "1 minute",
                                "seconds_watched", "seconds_watched")


@register("stream_key_count", ORACLES["sliding_window_default_slide"])
def q_stream_key_count(spark, sf):
    ev = events_stream(spark, sf)
    lines = ev.select("ts", F.concat_ws(",", "event_type", F.col("ts").cast("string"))
                      .alias("value"))
    # 2-second bucket counts in the stream; 2-minute windows built from them
    buckets = SJ.level_counts(lines, "ts", "value", ",", "2 seconds", None, replay_watermark(spark, sf))
    latest = _run_versioned(spark, buckets, "key-count", ["window_start", "window_end", "level"])
    return sliding_from_buckets(latest, "window_start", "level", "2 minutes", "2 seconds", "n", "n")


@register("micro_batch_trigger", ORACLES["tumbling_event_window"])
def q_micro_batch_trigger(spark, sf):
    """The tumbling job under a fixed 1-second processing-time trigger."""
    agg = SJ.seconds_per_course(events_stream(spark, sf), "ts", "event_type", "2 minutes", watermark=replay_watermark(spark, sf))
    out = scratch_path(spark, "sink-interval")
    remove_at_exit(spark, out)
    run_on_interval(versioned_writer(agg, out), spark, "interval", "1 second",
                    state_partitions=default_state_partitions(spark))
    return latest_versions(spark, out, ["window_start", "window_end", "course_name"], agg.schema)


@register("stream_watermark_append", """
select time_bucket(interval 2 minute, ts) as window_start,
       time_bucket(interval 2 minute, ts) + interval 2 minute as window_end,
       event_type as course_name, cast(sum(5) as bigint) as seconds_watched
from events group by 1, 2, 3
having time_bucket(interval 2 minute, ts) + interval 2 minute
       <= (select max(ts) from events) - interval 10 minute""")
def q_stream_watermark_append(spark, sf):
    """Append mode: a window is emitted once the watermark passes its end, and
    rows later than the watermark are dropped; the state stays bounded.

    Replaying one file gives one micro-batch, then a no-data batch moves the
    watermark to max(ts) - 10 minutes: exactly the windows ending by then are
    emitted (the oracle), the last ones stay open."""
    agg = SJ.seconds_per_course(events_stream(spark, sf), "ts", "event_type", "2 minutes",
                                watermark="10 minutes")
    out = scratch_path(spark, "sink-append")
    remove_at_exit(spark, out)
    writer = agg.writeStream.outputMode("append").format("parquet").option("path", out)
    run_until_done(writer, spark, "watermark-append", state_partitions=default_state_partitions(spark))
    return spark.read.schema(agg.schema).parquet(out)


@register("viewing_figures_stream", """
with s as (select time_bucket(interval 2 minute, ts) as window_start, event_type as course_name,
                  cast(sum(5) as bigint) as seconds_watched
           from events group by 1, 2)
select window_start, window_start + interval 2 minute as window_end, course_name,
       seconds_watched,
       cast(row_number() over (partition by window_start
                               order by seconds_watched desc, course_name) as integer) as rank
from s""")
def q_viewing_figures_stream(spark, sf):
    agg = SJ.seconds_per_course(events_stream(spark, sf), "ts", "event_type", "2 minutes", watermark=replay_watermark(spark, sf))
    latest = _run_versioned(spark, agg, "viewing-figures",
                            ["window_start", "window_end", "course_name"])
    return SJ.rank_within_windows(latest, "seconds_watched", "course_name")



@register("stream_sliding_ranked", """
with b as (select time_bucket(interval 10 minute, ts) as s, event_type, count(*) * 5 as v from events group by 1, 2),
     w as (select s - i * interval 10 minute as window_start, event_type as course_name, v
           from b, range(3) r(i)),
     t as (select window_start, course_name, cast(sum(v) as bigint) as seconds_watched from w group by 1, 2),
     k as (select *, cast(row_number() over (partition by window_start
                  order by seconds_watched desc, course_name) as integer) as rank from t)
select window_start, window_start + interval 30 minute as window_end, course_name, seconds_watched, rank
from k where rank <= 10""")
def q_stream_sliding_ranked(spark, sf):
    """Sliding windows kept by the stream itself (30 minutes, every 10), each
    micro-batch emitting the windows it changed; the ten best courses of each."""
    agg = SJ.seconds_per_course(events_stream(spark, sf), "ts", "event_type", "30 minutes", "10 minutes",
                                watermark=replay_watermark(spark, sf))
    latest = _run_versioned(spark, agg, "sliding-ranked", ["window_start", "window_end", "course_name"])
    return SJ.rank_within_windows(latest, "seconds_watched", "course_name", most=10)


@register("stream_top_emissions", """
with t as (select time_bucket(interval 2 minute, ts) as window_start, event_type as course_name,
                  cast(count(*) * 5 as bigint) as seconds_watched from events group by 1, 2),
     k as (select *, row_number() over (partition by window_start
                  order by seconds_watched desc, course_name) as r from t)
select window_start, window_start + interval 2 minute as window_end, course_name, seconds_watched,
       cast(r as integer) as rank from k where r <= 3""")
def q_stream_top_emissions(spark, sf):
    """Every trigger emits its changed windows ranked, as the reference prints them:
    the ranking runs inside each micro-batch on the complete window table."""
    agg = SJ.seconds_per_course(events_stream(spark, sf), "ts", "event_type", "2 minutes")
    out = scratch_path(spark, "sink-ranked")
    remove_at_exit(spark, out)
    ranked = lambda b: SJ.rank_within_windows(b, "seconds_watched", "course_name", most=3)
    run_until_done(versioned_writer(agg, out, "complete", each=ranked), spark, "ranked",
                   state_partitions=default_state_partitions(spark))
    schema = agg.schema.add("rank", "integer")
    return newest_batch(spark, out, schema)


# ---- delivery, restart and compaction ----------------------------------------

ARRIVALS, SPANS = 8, 3


def _arriving(spark, rows, name, n=ARRIVALS):
    """Rows as a folder of ``n`` files, the stand-in for a topic or a landing folder."""
    out = scratch_path(spark, f"arrivals-{name}")
    remove_at_exit(spark, out)
    rows.repartition(n, *[F.col(c) for c in rows.columns[:1]]).write.parquet(out)
    return file_stream(spark, out, rows.schema, max_files_per_trigger=1, glob="*.parquet")


@register("stream_delivered_once", """
select cast(event_id % 4 as integer) as partition, event_id as "offset", event_type as course_name,
       cast(user_id as varchar) as user_key
from events where event_id is not null""")
def q_stream_delivered_once(spark, sf):
    """At-least-once delivery: a topic's records, a third of them delivered again in other files, come
    out once each; key and value are decoded from their bytes."""
    ev = Tables(spark, sf).events.where("event_id is not null")
    record = ev.select(
        F.col("user_id").cast("string").cast("binary").alias("key"), F.col("event_type").cast("binary").alias("value"),
        F.lit("views").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), ntz_to_instant("ts").alias("timestamp"), F.lit(0).alias("timestampType"))
    again = record.where("offset % 3 = 0").withColumn("timestampType", F.lit(1))
    topic = _arriving(spark, record.unionByName(again).select("timestampType", *record.columns[:-1]), "topic")
    once = delivered_once(topic, replay_watermark(spark, sf))
    out = scratch_path(spark, "sink-once")
    remove_at_exit(spark, out)
    decoded = once.select("partition", "offset", F.col("value").cast("string").alias("course_name"),
                          F.col("key").cast("string").alias("user_key"))
    run_until_done(decoded.writeStream.outputMode("append").format("parquet").option("path", out), spark,
                   "delivered-once", state_partitions=default_state_partitions(spark))
    return spark.read.schema(decoded.schema).parquet(out)


@register("stream_arrival_windows", """
with b as (select time_bucket(interval 1 minute, ts) as b, event_type, count(*) as n
           from events where ts is not null group by 1, 2)
select event_type as course_name, b - k * interval 1 minute as window_start,
       b - k * interval 1 minute + interval 60 minute as window_end, cast(sum(n) * 5 as bigint) as seconds_watched
from b, range(60) r(k)
where b - k * interval 1 minute + interval 60 minute <= (select max(ts) from events) - interval 10 minute
group by 1, 2, 3""")
def q_stream_arrival_windows(spark, sf):
    """The last 60 minutes every minute by time of arrival, as state with timers: a ring of slide sums
    per course, added at the front and subtracted at the back.  The events arrive span by span in the
    order of ``ts``; after each span the query is started again on its checkpoint.  Windows come out
    until ten minutes before the last arrival."""
    ev = Tables(spark, sf).events.select("ts", "event_type")
    out, sink, checkpoint = (scratch_path(spark, f"arrival-{x}") for x in ("in", "sink", "state"))
    remove_at_exit(spark, out)
    remove_at_exit(spark, sink)
    ev.limit(0).write.parquet(out)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).head()
    stream = file_stream(spark, out, ev.schema, max_files_per_trigger=None, glob="*.parquet")
    sums = arrival_windows(stream, "ts", "event_type", wait="10 minutes")
    ends = [lo + (hi - lo) * i / SPANS for i in range(1, SPANS)] if lo is not None else []
    for at, to in zip([None, *ends], [*ends, None]):
        part = ev if at is None else ev.where(F.col("ts") >= F.lit(at))
        (part if to is None else part.where(F.col("ts") < F.lit(to))).write.mode("append").parquet(out)
        run_until_done(sums.writeStream.outputMode("append").format("parquet").option("path", sink), spark, "arrival",
                       checkpoint=checkpoint, state_partitions=default_state_partitions(spark), settings=ROCKSDB)
    return spark.read.schema(sums.schema).parquet(sink)


class _Fault(Exception):
    """Stands for a lost driver: raised once, after a batch was written and before it is committed."""


@register("stream_stop_resume", ORACLES["tumbling_event_window"])
def q_stream_stop_resume(spark, sf):
    """Stop and resume: the query ends twice between a batch's write and its commit and is started again
    on its checkpoint; the batch is written again in its own place, the state goes on from before it."""
    ev = _arriving(spark, Tables(spark, sf).events.select("event_id", "ts", "event_type"), "resume")
    agg = SJ.seconds_per_course(ev, "ts", "event_type", "2 minutes", watermark=replay_watermark(spark, sf))
    out, checkpoint = scratch_path(spark, "sink-resume"), scratch_path(spark, "resume")
    remove_at_exit(spark, out)
    faults = {2, 5}

    def write(batch, batch_id):
        write_version(batch, batch_id, out)
        if batch_id in faults:
            faults.remove(batch_id)
            raise _Fault(f"after batch {batch_id}")

    run_with_restarts(lambda: agg.writeStream.outputMode("update").foreachBatch(write), spark, "resume", checkpoint,
                      state_partitions=default_state_partitions(spark))
    return latest_versions(spark, out, ["window_start", "window_end", "course_name"], agg.schema)


@register("stream_compacted", ORACLES["tumbling_event_window"])
def q_stream_compacted(spark, sf):
    """The versioned sink with compaction: after every third batch the versions before it become one."""
    ev = _arriving(spark, Tables(spark, sf).events.select("event_id", "ts", "event_type"), "compact")
    agg = SJ.seconds_per_course(ev, "ts", "event_type", "2 minutes", watermark=replay_watermark(spark, sf))
    out, keys = scratch_path(spark, "sink-compact"), ["window_start", "window_end", "course_name"]
    remove_at_exit(spark, out)
    run_until_done(versioned_writer(agg, out, keys=keys, compact_every=3), spark, "compact",
                   state_partitions=default_state_partitions(spark))
    return latest_versions(spark, out, keys, agg.schema)
