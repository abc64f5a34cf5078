"""Streaming jobs.  The windowing logic is the batch code of
``tidewater.operators.windows``; only source, watermark and sink differ.

Sliding windows on a stream: either aggregate ``window(ts, D, S)`` directly
(each event updates D/S windows of state), or -- cheaper at scale -- keep
tumbling S-wide bucket sums in the stream and build the D-long windows from
the bucket table with ``operators.windows.sliding_from_buckets``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import instant_to_ntz, ntz_to_instant, split_field
from tidewater.operators.windows import window_agg


def with_event_time(df: DataFrame, ts: str, out: str = "event_time") -> tuple[DataFrame, bool]:
    """Add a ``timestamp`` event-time column (watermarks refuse timestamp_ntz).

    Returns the frame and whether the input was NTZ (to convert back on output).
    """
    is_ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    col = ntz_to_instant(ts) if is_ntz else F.col(ts).cast("timestamp")
    return df.withColumn(out, col), is_ntz


def _restore(df: DataFrame, is_ntz: bool) -> DataFrame:
    if not is_ntz:
        return df
    return (df.withColumn("window_start", instant_to_ntz("window_start"))
              .withColumn("window_end", instant_to_ntz("window_end")))


def seconds_per_course(stream: DataFrame, ts: str, course: str, duration: str = "2 minutes",
                       slide: str | None = None, watermark: str | None = None,
                       seconds_per_view: int = 5) -> DataFrame:
    """Seconds watched per course per event-time window (one view = fixed seconds).

    Columns: window_start, window_end, course_name, seconds_watched.
    """
    s, is_ntz = with_event_time(stream.select(ts, F.col(course).alias("course_name")), ts)
    if watermark:
        s = s.withWatermark("event_time", watermark)
    out = window_agg(s, "event_time", "course_name", duration, slide,
                     {"seconds_watched": F.sum(F.lit(seconds_per_view)).cast("long")})
    return _restore(out, is_ntz)


def level_counts(lines: DataFrame, ts: str, line_col: str = "value", sep: str = ",",
                 duration: str = "2 minutes", slide: str | None = "2 seconds",
                 watermark: str | None = None) -> DataFrame:
    """Count of the first field of each line ('LEVEL,...') per sliding window.

    Columns: window_start, window_end, level, n.
    """
    s, is_ntz = with_event_time(
        lines.select(ts, split_field(line_col, sep, 1).alias("level")), ts)
    if watermark:
        s = s.withWatermark("event_time", watermark)
    out = window_agg(s, "event_time", "level", duration, slide, {"n": F.count(F.lit(1))})
    return _restore(out, is_ntz)


def rank_within_windows(df: DataFrame, value: str, key: str, rank_name: str = "rank",
                        most: int | None = None) -> DataFrame:
    """Descending rank of ``value`` inside each window (key breaks ties).

    With ``most``, the first so many of each window: Spark then keeps at most
    that many rows per window in every task before the shuffle.  Without it a
    window's rows (one per key) are ranked in one task.
    """
    from pyspark.sql import Window
    w = Window.partitionBy("window_start", "window_end").orderBy(F.col(value).desc(), F.col(key))
    ranked = df.withColumn(rank_name, F.row_number().over(w))
    return ranked if most is None else ranked.where(F.col(rank_name) <= most)
