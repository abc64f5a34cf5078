"""Sliding sums by time of arrival, kept by the stream itself with timers.

A window of length D that moves by S is the sum of D/S slides.  The stream
first sums each slide (partial sums are made before its shuffle, so a busy key
sends a row per task and slide).  Closed slides go to a state per key: a ring
of the slide sums of the last D.  When the watermark passes the end of a slide
a timer fires; each window that ended is the one before it plus the slide at
its front minus the one that left at its back.  A key whose ring has run empty
keeps neither state nor timer.

Needs the RocksDB state store (``runner.ROCKSDB``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewater.streaming.jobs import _restore, with_event_time

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def windows_ended(ring: dict[int, int], due: int, now: int, length: int,
                  slide: int) -> tuple[list[tuple[int, int]], dict[int, int], int | None]:
    """The windows that end from ``due`` to ``now`` (ends are multiples of ``slide``).

    ``ring`` maps a slide's start to its sum.  Returns ((end, sum) of each
    window that holds a slide, the slides still needed, the next end that is
    due or None).  Time goes by slides and windows with rows, not by the clock:
    empty stretches are jumped over.
    """
    out = []
    starts = sorted(ring)
    total = sum(ring[s] for s in starts if due - length - slide <= s < due - slide)
    end, held = due, sum(1 for s in starts if due - length - slide <= s < due - slide)
    while end <= now:
        if end - slide in ring:
            total, held = total + ring[end - slide], held + 1
        if end - slide - length in ring:
            total, held = total - ring[end - slide - length], held - 1
        if held:
            out.append((end, total))
            end += slide
            continue
        end = min((s + slide for s in starts if s + slide > end), default=None)
        if end is None:
            return out, {}, None
    left = {s: v for s, v in ring.items() if s + length >= end}
    return out, left, end if left else None


class SlidingSums(StatefulProcessor):
    """Rows (key, slide start in ms, sum) in; (key, window_start, window_end, sum) out."""

    def __init__(self, length_ms: int, slide_ms: int):
        self.length, self.slide = length_ms, slide_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getListState("ring", "start bigint, total bigint")

    def handleInputRows(self, key, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        ring = dict(self.ring.get()) if self.ring.exists() else {}
        new = {}
        for r in rows:
            new[r["slide_ms"]] = new.get(r["slide_ms"], 0) + r["total"]
        for start, total in new.items():
            ring[start] = ring.get(start, 0) + total
        if ring:
            self.ring.put(sorted(ring.items()))
            timers, first = list(self.handle.listTimers()), min(new) + self.slide
            if not timers or first < min(timers):
                for t in timers:
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        ring = dict(self.ring.get()) if self.ring.exists() else {}
        now = timerValues.getCurrentWatermarkInMs()
        ended, left, due = windows_ended(ring, expiredTimerInfo.getExpiryTimeInMs(), now, self.length, self.slide)
        if left:
            self.ring.put(sorted(left.items()))
            self.handle.registerTimer(due)
        else:
            self.ring.clear()
        for end, total in ended:
            yield Row(course_name=key[0], window_start=EPOCH + dt.timedelta(milliseconds=end - self.length),
                      window_end=EPOCH + dt.timedelta(milliseconds=end), seconds_watched=total)

    def close(self) -> None:
        pass


def arrival_windows(stream: DataFrame, arrival: str, course: str, length_minutes: int = 60, slide_minutes: int = 1,
                    wait: str = "0 seconds", seconds_per_view: int = 5) -> DataFrame:
    """Seconds watched per course in the last ``length_minutes``, each time ``slide_minutes`` pass.

    ``arrival`` holds each row's time of arrival (a topic's record timestamp,
    say); the clock is its watermark, ``wait`` behind the newest arrival.
    A window comes out once, when it has ended, if it holds a row; rows that
    arrive behind the clock and null arrivals are dropped, a null course is a
    course of its own.  Columns: course_name, window_start, window_end,
    seconds_watched.  Output mode: append.
    """
    s, is_ntz = with_event_time(stream.select(arrival, F.col(course).alias("course_name")), arrival)
    slides = (s.withWatermark("event_time", wait)
              .groupBy(F.window("event_time", f"{slide_minutes} minutes"), "course_name")
              .agg(F.sum(F.lit(seconds_per_view)).cast("long").alias("total"))
              .select("window", "course_name", F.unix_millis("window.start").alias("slide_ms"), "total"))
    summed = slides.groupBy("course_name").transformWithState(
        SlidingSums(length_minutes * 60_000, slide_minutes * 60_000),
        "course_name string, window_start timestamp, window_end timestamp, seconds_watched bigint",
        outputMode="append", timeMode="eventTime")
    return _restore(summed, is_ntz)
