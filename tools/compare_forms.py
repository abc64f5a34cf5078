"""Time the plain Spark form of each rewrite against ours at one scale factor.

    python tools/compare_forms.py [sf_dir]

Prints a markdown table: best-of-3 seconds and shuffle bytes written (event
log) for window() expand vs sliding_sum, and pivot() vs the conditional pivot.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidewater.operators.pivot import pivot_agg  # noqa: E402
from tidewater.operators.windows import sliding_sum, window_agg  # noqa: E402
from tidewater.session import build_session  # noqa: E402
from tidewater.sources.tables import Tables  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tidewater-eventlog-")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    t = Tables(spark, sf)
    ev = t.events.select("ts", F.col("event_type").alias("k"), "user_id", "value")
    forms = {
        "window(ts, 60m, 1m) expand": lambda: window_agg(ev, "ts", "k", "60 minutes", "1 minute",
                                                         {"n": F.count(F.lit(1))}),
        "sliding_sum 60m/1m": lambda: sliding_sum(ev, "ts", "k", "60 minutes", "1 minute", None, "n"),
        "window(ts, 2m, 2s) expand": lambda: window_agg(ev, "ts", "k", "2 minutes", "2 seconds",
                                                        {"n": F.count(F.lit(1))}),
        "sliding_sum 2m/2s": lambda: sliding_sum(ev, "ts", "k", "2 minutes", "2 seconds", None, "n"),
        "pivot() user x type": lambda: pivot_agg(ev, "user_id", "k", F.sum("value"),
                                                 ["click", "error", "purchase", "signup", "view"]),
        "conditional pivot user x type": lambda: pivot_agg(
            ev, "user_id", "k", {"sum": (F.sum, "value")},
            ["click", "error", "purchase", "signup", "view"]),
    }
    sc = spark.sparkContext
    times = {}
    for name, build in forms.items():
        build().write.format("noop").mode("overwrite").save()          # warm-up
        best = float("inf")
        for i in range(3):
            sc.setJobGroup(name if i == 0 else f"again:{name}", name)
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        times[name] = best
    spark.stop()
    written = {n: 0 for n in forms}
    stage_group = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path):
            continue
        for line in open(path, errors="replace"):
            try:
                ev_ = json.loads(line)
            except ValueError:
                continue
            if ev_.get("Event") == "SparkListenerJobStart":
                g = (ev_.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev_.get("Stage IDs", []):
                    if g in written:
                        stage_group[sid] = g
            elif ev_.get("Event") == "SparkListenerTaskEnd" and ev_.get("Stage ID") in stage_group:
                w = (ev_.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                written[stage_group[ev_["Stage ID"]]] += int(w.get("Shuffle Bytes Written", 0))
    print("| form | sec (best of 3) | shuffle bytes written |")
    print("| --- | --- | --- |")
    for n in forms:
        print(f"| {n} | {times[n]:.3f} | {written[n]:,} |")


if __name__ == "__main__":
    main(sys.argv)
