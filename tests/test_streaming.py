"""Batch = stream for the windowed jobs over several micro-batches with
out-of-order and late rows; watermark behaviour; source/sink builders."""
from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators.windows import window_agg
from tidewater.session import scratch_path
from tidewater.sources.streams import (console_sink, console_sink_options, file_stream,
                                       kafka_options)
from tidewater.streaming import jobs as SJ
from tidewater.streaming.arrival import arrival_windows, windows_ended
from tidewater.streaming.runner import (ROCKSDB, latest_versions, run_until_done, trigger_options,
                                        versioned_writer)

SCHEMA = "ts timestamp_ntz, event_type string"


def _write_batches(spark, batches):
    """Each batch becomes one parquet file in arrival order (file names sort)."""
    d = scratch_path(spark, "stream-in")
    for i, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(f"{d}/batch={i:03d}")
    return d


def _t(h, m, s=0):
    return dt.datetime(2024, 1, 1, h, m, s)


BATCHES = [
    [(_t(10, 0, 5), "a"), (_t(10, 1, 0), "b"), (_t(10, 3, 59), "a")],
    [(_t(10, 2, 0), "a"), (_t(9, 58, 0), "b"), (_t(10, 6, 0), "a")],     # out of order
    [(_t(10, 1, 30), "a"), (_t(10, 10, 0), "b"), (_t(10, 0, 0), "a")],   # late rows
]


def _stream(spark, d):
    schema = spark.createDataFrame([], SCHEMA).schema
    return file_stream(spark, d, schema, max_files_per_trigger=1,
                       glob="*.parquet").select("ts", "event_type")


def test_stream_equals_batch_over_three_micro_batches(spark):
    d = _write_batches(spark, BATCHES)
    agg = SJ.seconds_per_course(_stream(spark, d), "ts", "event_type", "2 minutes")
    out = scratch_path(spark, "sink")
    run_until_done(versioned_writer(agg, out), spark, "test-equal")
    batches = spark.read.parquet(out).select("batch_id").distinct().count()
    assert batches == 3
    got = latest_versions(spark, out, ["window_start", "window_end", "course_name"], agg.schema)
    flat = spark.createDataFrame([r for b in BATCHES for r in b], SCHEMA) \
        .withColumnRenamed("event_type", "course_name")
    want = window_agg(flat, "ts", "course_name", "2 minutes", None,
                      {"seconds_watched": F.sum(F.lit(5)).cast("long")})
    cols = ["window_start", "window_end", "course_name", "seconds_watched"]
    assert rows(got, *cols) == rows(want, *cols)


def test_sliding_stream_equals_batch(spark):
    d = _write_batches(spark, BATCHES)
    lines = _stream(spark, d).select("ts", F.concat_ws(",", "event_type", F.lit("x")).alias("value"))
    agg = SJ.level_counts(lines, "ts", "value", ",", "4 minutes", "2 minutes")
    out = scratch_path(spark, "sink")
    run_until_done(versioned_writer(agg, out), spark, "test-sliding")
    got = latest_versions(spark, out, ["window_start", "window_end", "level"], agg.schema)
    flat = spark.createDataFrame([r for b in BATCHES for r in b], SCHEMA).withColumnRenamed("event_type", "level")
    want = window_agg(flat, "ts", "level", "4 minutes", "2 minutes", {"n": F.count(F.lit(1))})
    cols = ["window_start", "window_end", "level", "n"]
    assert rows(got, *cols) == rows(want, *cols)


def test_watermark_drops_late_rows_in_append_mode(spark):
    # Spark filters late input with the watermark of the *previous* trigger
    # (10:20 here from batch 2 on), so the late rows arrive in the third batch.
    batches = [
        [(_t(10, 0, 0), "a"), (_t(10, 30, 0), "a")],   # watermark becomes 10:20
        [(_t(10, 25, 0), "a")],                          # on time
        [(_t(9, 0, 0), "a"), (_t(10, 0, 30), "a")],     # both older than 10:20: dropped
        [(_t(11, 0, 0), "a")],
    ]
    d = _write_batches(spark, batches)
    agg = SJ.seconds_per_course(_stream(spark, d), "ts", "event_type", "2 minutes",
                                watermark="10 minutes")
    out = scratch_path(spark, "append")
    run_until_done(agg.writeStream.outputMode("append").format("parquet").option("path", out),
                   spark, "test-append")
    got = {r["window_start"]: r["seconds_watched"] for r in spark.read.parquet(out).collect()}
    assert _t(9, 0) not in got                      # late row dropped
    assert got[_t(10, 0)] == 5                       # 10:00:30 arrived late: not counted
    assert got[_t(10, 24)] == 5 and got[_t(10, 30)] == 5
    assert _t(11, 0) not in got                      # still inside the watermark at the end


def test_rank_within_windows(spark):
    df = spark.createDataFrame([(_t(1, 0), _t(1, 2), "a", 5), (_t(1, 0), _t(1, 2), "b", 10),
                                (_t(1, 0), _t(1, 2), "c", 10)],
                               "window_start timestamp_ntz, window_end timestamp_ntz, k string, v int")
    got = rows(SJ.rank_within_windows(df, "v", "k"), "k", "rank")
    assert got == [("a", 3), ("b", 1), ("c", 2)]


def test_kafka_options_and_console_sink():
    o = kafka_options("localhost:9092", "viewrecords", group_id="spark-group")
    assert o["subscribe"] == "viewrecords" and o["startingOffsets"] == "latest"
    assert o["kafka.group.id"] == "spark-group" and o["kafka.bootstrap.servers"] == "localhost:9092"
    assert console_sink_options() == {"numRows": "50", "truncate": "false"}
    assert trigger_options("2 seconds") == {"processingTime": "2 seconds"}
    assert trigger_options() == {"availableNow": True}


def test_console_sink_builds_writer(spark):
    d = _write_batches(spark, BATCHES[:1])
    w = console_sink(_stream(spark, d).groupBy("event_type").count(), "update")
    assert w is not None


def test_state_partitions_fixed_at_first_start(spark):
    d = _write_batches(spark, BATCHES)
    agg = SJ.seconds_per_course(_stream(spark, d), "ts", "event_type", "2 minutes")
    out = scratch_path(spark, "sink")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    from tidewater.streaming.runner import start
    ckpt = scratch_path(spark, "ckpt")
    q = start(versioned_writer(agg, out), spark, "parts", checkpoint=ckpt, state_partitions=3)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    import os
    state = os.path.join(ckpt.replace("file:", ""), "state", "0")
    assert sorted(os.listdir(state)) == ["0", "1", "2"] or sorted(
        d for d in os.listdir(state) if d.isdigit()) == ["0", "1", "2"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_versioned_sink_replay_is_idempotent(spark):
    from tidewater.streaming.runner import write_version
    out = scratch_path(spark, "versions")
    b0 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    b1 = spark.createDataFrame([("a", 5)], "k string, v int")
    write_version(b0, 0, out)
    write_version(b1, 1, out)
    write_version(b1, 1, out)                       # replayed batch
    assert rows(latest_versions(spark, out, ["k"], b0.schema)) == [("a", 5), ("b", 2)]
    assert spark.read.parquet(out).count() == 3
    single = scratch_path(spark, "versions")
    write_version(b0, 0, single)
    assert rows(latest_versions(spark, single, ["k"], b0.schema)) == [("a", 1), ("b", 2)]


def test_sliding_windows_from_streamed_buckets_equal_batch(spark):
    from tidewater.operators.windows import sliding_from_buckets
    d = _write_batches(spark, BATCHES)
    buckets = SJ.seconds_per_course(_stream(spark, d), "ts", "event_type", "2 minutes")
    out = scratch_path(spark, "sink")
    run_until_done(versioned_writer(buckets, out), spark, "test-buckets")
    latest = latest_versions(spark, out, ["window_start", "window_end", "course_name"], buckets.schema)
    got = sliding_from_buckets(latest, "window_start", "course_name", "6 minutes", "2 minutes",
                               "seconds_watched", "seconds_watched")
    flat = spark.createDataFrame([r for b in BATCHES for r in b], SCHEMA) \
        .withColumnRenamed("event_type", "course_name")
    want = window_agg(flat, "ts", "course_name", "6 minutes", "2 minutes",
                      {"seconds_watched": F.sum(F.lit(5)).cast("long")})
    cols = ["window_start", "window_end", "course_name", "seconds_watched"]
    assert rows(got, *cols) == rows(want, *cols)


def test_streams_read_a_table_stored_as_a_folder(spark, small_dir, tmp_path):
    from tidewater.plans import queries_io as Q
    from tidewater.plans.catalog import queries
    events = spark.read.parquet(f"{small_dir}/events.parquet")
    events.repartition(5, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    for key in ("stream_file_source", "stream_tumbling_update", "stream_sliding_sum", "stream_key_count",
                "stream_watermark_append", "micro_batch_trigger", "viewing_figures_stream", "stream_sliding_ranked",
                "stream_top_emissions"):
        one, many = (queries()[key](spark, d) for d in (small_dir, str(tmp_path)))
        assert rows(many) == rows(one) and one.count() > 0, key
    # one file per micro-batch: five versions of the windows, the same result
    agg = SJ.seconds_per_course(Q.events_stream(spark, str(tmp_path), 1), "ts", "event_type", "2 minutes",
                                watermark=Q.replay_watermark(spark, str(tmp_path)))
    out = scratch_path(spark, "sink")
    run_until_done(versioned_writer(agg, out), spark, "files", state_partitions=3)
    assert spark.read.parquet(out).select("batch_id").distinct().count() >= 5
    keys = ["window_start", "window_end", "course_name"]
    got = latest_versions(spark, out, keys, agg.schema)
    assert rows(got, *keys, "seconds_watched") == rows(
        queries()["stream_tumbling_update"](spark, small_dir), *keys, "seconds_watched")


def test_an_empty_stream_gives_an_empty_table(spark, small_dir, tmp_path):
    from tidewater.plans.catalog import queries
    (spark.read.parquet(f"{small_dir}/events.parquet").where("false").write.parquet(f"{tmp_path}/events.parquet"))
    for key in ("stream_file_source", "stream_tumbling_update", "viewing_figures_stream"):
        df = queries()[key](spark, str(tmp_path))
        assert df.count() == 0 and df.columns == queries()[key](spark, small_dir).columns


def test_state_partitions_leave_the_session_alone(spark, small_dir):
    from tidewater.plans.catalog import queries
    before = spark.conf.get("spark.sql.shuffle.partitions")
    queries()["stream_file_source"](spark, small_dir)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_folder_over_several_years_loses_nothing(spark, tmp_path):
    """One file per trigger, the newest year first: no event falls behind the watermark."""
    from tidewater.plans import queries_io as Q
    from tidewater.sources.tables import SCHEMAS
    for i, year in enumerate((2024, 2019, 2022, 2016)):
        day = [(k, dt.datetime(year, 3, 1 + k % 20, k % 24, k % 60), k % 7, "ab"[k % 2], 1.0, "") for k in range(60)]
        spark.createDataFrame(day, SCHEMAS["events"]).coalesce(1).write.parquet(f"{tmp_path}/events.parquet/{i}")
    spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/events.parquet").write.parquet(f"{tmp_path}/flat/events.parquet")
    flat = f"{tmp_path}/flat"
    agg = SJ.seconds_per_course(Q.events_stream(spark, flat, 1), "ts", "event_type", "2 minutes",
                                watermark=Q.replay_watermark(spark, flat))
    out = scratch_path(spark, "sink")
    run_until_done(versioned_writer(agg, out), spark, "years")
    keys = ["window_start", "window_end", "course_name"]
    assert latest_versions(spark, out, keys, agg.schema).agg(F.sum("seconds_watched")).head()[0] == 4 * 60 * 5


def test_compaction_bounds_the_versions_read(spark):
    from tidewater.streaming.runner import compact_versions, versions, write_version
    out = scratch_path(spark, "compact")
    schema = spark.createDataFrame([], "k string, v int").schema
    want = {}
    for i in range(11):
        part = [(f"k{j % 5}", 100 * i + j) for j in range(i % 4 + 1)]
        want.update(dict(part))
        if i and i % 3 == 0:
            compact_versions(spark, out, ["k"], schema, i - 1)
        write_version(spark.createDataFrame(part, schema), i, out)
        write_version(spark.createDataFrame(part, schema), i, out)      # replayed
        merged, batches = versions(spark, out)
        assert len(merged) + len(batches) <= 4
        assert dict(rows(latest_versions(spark, out, ["k"], schema))) == want
    # a merge cut off before its end is not read, and repeating one changes nothing
    merged, batches = versions(spark, out)
    spark.createDataFrame([("k0", -1)], schema).write.parquet(f"{out}/merged/upto=10")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/merged/upto=10/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert versions(spark, out) == (merged, batches)
    for _ in range(2):
        compact_versions(spark, out, ["k"], schema, 10)
        assert dict(rows(latest_versions(spark, out, ["k"], schema))) == want
    assert versions(spark, out)[1] == {}


def test_a_stream_is_resumed_from_its_checkpoint(spark):
    from tidewater.streaming.runner import run_with_restarts, write_version
    d = _write_batches(spark, BATCHES)
    agg = SJ.seconds_per_course(_stream(spark, d), "ts", "event_type", "2 minutes")
    out, written, faults = scratch_path(spark, "sink"), [], [0, 2]

    def write(batch, batch_id):
        write_version(batch, batch_id, out)
        written.append(batch_id)
        if batch_id in faults:
            faults.remove(batch_id)
            raise ValueError("lost")

    n = run_with_restarts(lambda: agg.writeStream.outputMode("update").foreachBatch(write), spark, "resumed",
                          scratch_path(spark, "ckpt"))
    assert n == 2 and written[:4] == [0, 0, 1, 2] and written.count(2) == 2
    whole = scratch_path(spark, "sink")
    run_until_done(versioned_writer(agg, whole), spark, "uninterrupted")
    keys = ["window_start", "window_end", "course_name"]
    a, b = (latest_versions(spark, p, keys, agg.schema) for p in (out, whole))
    assert rows(a, *keys, "seconds_watched") == rows(b, *keys, "seconds_watched")


def test_a_fault_that_stays_is_raised(spark):
    import pytest
    from tidewater.streaming.runner import run_with_restarts
    d = _write_batches(spark, BATCHES)

    def fail(batch, batch_id):
        raise ValueError("always")

    with pytest.raises(Exception, match="always"):
        run_with_restarts(lambda: _stream(spark, d).writeStream.foreachBatch(fail), spark, "broken",
                          scratch_path(spark, "ckpt"), restarts=1)


# ---- windows by time of arrival --------------------------------------------

def _ended(ring, due, now, length, slide):
    """Every window from ``due`` to ``now``, each summed on its own."""
    out = []
    for end in range(due, now + 1, slide):
        inside = [v for s, v in ring.items() if end - length <= s < end]
        if inside:
            out.append((end, sum(inside)))
    return out


@given(st.dictionaries(st.integers(0, 60), st.integers(0, 9), min_size=1, max_size=20),
       st.integers(1, 8), st.integers(1, 5), st.lists(st.integers(0, 90), max_size=5))
@settings(max_examples=200, deadline=None)
def test_the_ring_gives_every_window_once(slides, n, slide, clock):
    """Any slides, window lengths and clocks: the windows of all calls are those summed one by one."""
    ring = {s * slide: v for s, v in slides.items()}
    length, due, got, left = n * slide, min(ring) + slide, [], dict(ring)
    for now in [*sorted(c * slide for c in clock), 200 * slide]:
        if due is None or due > now:
            continue
        some, left, due = windows_ended(left, due, now, length, slide)
        got += some
        assert (due is None) == (not left) and (due is None or due > now)
    assert got == _ended(ring, min(ring) + slide, 200 * slide, length, slide)
    assert not left


def test_arrival_windows_over_several_batches(spark):
    """Gaps longer than a window, a null course, a null arrival, one file a batch."""
    batches = [[(_t(10, 0, 5), "a"), (_t(10, 1, 0), "b"), (_t(10, 3, 59), "a"), (None, "a")],
               [(_t(10, 6, 0), "a"), (_t(10, 6, 30), None), (_t(10, 6, 40), "a")],
               [(_t(10, 30, 30), "b")], [(_t(11, 0, 0), "c")]]
    d = _write_batches(spark, batches)
    sums = arrival_windows(_stream(spark, d), "ts", "event_type", length_minutes=5, wait="0 seconds")
    out = scratch_path(spark, "sink")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    run_until_done(sums.writeStream.outputMode("append").format("parquet").option("path", out), spark, "test-arrival",
                   state_partitions=2, settings=ROCKSDB)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    got = {(r.course_name, r.window_end): r.seconds_watched for r in spark.read.schema(sums.schema).parquet(out).collect()}
    want, last = {}, _t(11, 0)
    for ts, course in (r for b in batches for r in b if r[0] is not None):
        first = ts.replace(second=0) + dt.timedelta(minutes=1)
        for k in range(5):
            if first + dt.timedelta(minutes=k) <= last:
                key = (course, first + dt.timedelta(minutes=k))
                want[key] = want.get(key, 0) + 5
    assert got == want
