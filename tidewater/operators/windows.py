"""Event-time windows over batch DataFrames (streams reuse the same code).

``window_agg`` is the plain ``groupBy(window(ts, ...), keys)`` form.
``sliding_sum`` rewrites an additive sliding aggregate (sum / count) so the
window fan-out happens *after* a pre-aggregation to slide-width buckets:
``window(ts, D, S)`` copies every input row D/S times (an Expand node), while
pre-aggregating first copies one row per (bucket, key) instead.  Exact when
S divides D, which is checked.
"""

from __future__ import annotations

import re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
          "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000}


def duration_micros(text: str) -> int | None:
    """'2 minutes' -> 120000000; None for forms this helper does not read."""
    total = 0
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?\b", text.strip().lower())
    if not parts:
        return None
    for n, unit in parts:
        if unit not in _UNITS:
            return None
        total += int(n) * _UNITS[unit]
    return total


def _keys(keys) -> list:
    if keys is None:
        return []
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def window_agg(df: DataFrame, ts: str, keys, duration: str, slide: str | None,
               measures: dict[str, Column]) -> DataFrame:
    """Aggregate per (window, keys); columns window_start, window_end, keys..., measures.

    Groups by the ``window`` struct itself (not by ``window.start``): on a
    stream that is what lets a watermark on ``ts`` bound the state.
    """
    w = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    ks = _keys(keys)
    g = df.groupBy(w.alias("window"), *ks).agg(*[m.alias(n) for n, m in measures.items()])
    return g.select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    *ks, *measures.keys())


def _floor_to(c: Column, width: int) -> Column:
    return c - F.pmod(c, F.lit(width))


def _instant_micros(df: DataFrame, ts: str) -> tuple[Column, bool]:
    from tidewater.functions.columns import ntz_to_instant
    is_ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    instant = ntz_to_instant(ts) if is_ntz else F.col(ts).cast("timestamp")
    return F.unix_micros(instant), is_ntz


def _windows_from_bucket_micros(pre: DataFrame, ks: list, d: int, s: int, name: str,
                                is_ntz: bool) -> DataFrame:
    """(``_bucket`` micros, keys, ``_part``) rows -> sliding windows D long every S.

    Each bucket row is routed to its D-wide time chunk and to the chunk before
    (a window starting in chunk c only covers buckets of c and c + 1) and
    shuffled by (chunk, keys): 2 rows per bucket, and a (chunk, key) group
    never holds more than 2·D/S rows, so a hot key cannot skew it.  Inside
    each task every bucket fans out to the window starts of its partition's
    chunk and the windows are summed -- already clustered, no further shuffle.
    """
    from tidewater.functions.columns import instant_to_ntz
    n = d // s
    chunk = _floor_to(F.col("_bucket"), d)
    routed = (pre.select(F.explode(F.array(chunk, chunk - F.lit(d))).alias("_chunk"), *ks,
                         "_bucket", "_part")
              .repartition("_chunk", *ks))
    # only the starts inside the row's own chunk: the first multiple of S there, to its last
    first = F.greatest(F.col("_bucket") - F.lit((n - 1) * s),
                       F.col("_chunk") + F.pmod(F.col("_bucket") - F.col("_chunk"), F.lit(s)))
    last = F.least(F.col("_bucket"), F.col("_chunk") + F.lit(d - 1))
    starts = F.when(first <= last, F.sequence(first, last, F.lit(s)))
    fanned = routed.select("_chunk", *ks, F.explode(starts).alias("_start"), "_part")
    per_window = fanned.groupBy("_chunk", *ks, "_start").agg(F.sum("_part").alias(name))

    def as_ts(c):
        t = F.timestamp_micros(c)
        return instant_to_ntz(t) if is_ntz else t

    return per_window.select(as_ts(F.col("_start")).alias("window_start"),
                             as_ts(F.col("_start") + F.lit(d)).alias("window_end"), *ks, name)


def _divisible(duration: str, slide: str) -> tuple[int, int] | None:
    d, s = duration_micros(duration), duration_micros(slide)
    if d is None or s is None or s <= 0 or d % s != 0:
        return None
    return d, s


def sliding_sum(df: DataFrame, ts: str, keys, duration: str, slide: str,
                value: Column | None, name: str) -> DataFrame:
    """Sliding-window sum (``value=None``: row count) of windows D long every S.

    ``window(ts, D, S)`` copies every input row D/S times before anything is
    combined.  Here each row first goes to the start of its S-wide bucket
    (integer micros, ``m - pmod(m, S)``) and is summed per (bucket, keys) --
    one shuffle of at most one row per bucket and key per task -- and the
    windows are then built from the bucket sums (:func:`sliding_from_buckets`,
    chunk-routed, no third shuffle).

    Exact for sums and counts; windows are aligned to the epoch as
    ``window()`` aligns them.  Falls back to :func:`window_agg` when S does
    not divide D.
    """
    ds = _divisible(duration, slide)
    measure = F.lit(1) if value is None else value
    if ds is None:
        return window_agg(df, ts, keys, duration, slide, {name: F.sum(measure)})
    d, s = ds
    ks = _keys(keys)
    micros, is_ntz = _instant_micros(df, ts)
    pre = df.groupBy(_floor_to(micros, s).alias("_bucket"), *ks).agg(F.sum(measure).alias("_part"))
    return _windows_from_bucket_micros(pre, ks, d, s, name, is_ntz)


def sliding_from_buckets(buckets: DataFrame, bucket_start: str, keys, duration: str, slide: str,
                         part: str, name: str) -> DataFrame:
    """Sliding windows from rows already summed per S-wide bucket.

    ``buckets`` holds one row per (bucket start, keys) with a partial sum
    ``part`` -- e.g. the table a streaming query maintains with a *tumbling*
    S-wide aggregation, whose state is D/S times smaller than that of the
    sliding aggregation itself.  Bucket starts must be aligned to S.
    """
    ds = _divisible(duration, slide)
    if ds is None:
        raise ValueError(f"slide {slide!r} must divide duration {duration!r}")
    d, s = ds
    ks = _keys(keys)
    micros, is_ntz = _instant_micros(buckets, bucket_start)
    pre = buckets.select(micros.alias("_bucket"), *ks, F.col(part).alias("_part"))
    return _windows_from_bucket_micros(pre, ks, d, s, name, is_ntz)


def top_k_per_window(df: DataFrame, ts: str, duration: str, key: str, value: Column,
                     k: int, total_name: str, rank_name: str = "rank") -> DataFrame:
    """Per tumbling window, the k keys with the largest total (key breaks ties)."""
    from tidewater.operators.relational import top_k_per_group
    per_key = window_agg(df, ts, key, duration, None, {total_name: F.sum(value)})
    return top_k_per_group(per_key, ["window_start", "window_end"],
                           [F.col(total_name).desc(), F.col(key).asc()], k, rank_name)
