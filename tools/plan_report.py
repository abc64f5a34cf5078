"""Summarise the physical plan of every batch query -> PLANS.md.

    python tools/plan_report.py [sf_dir] > PLANS.md

Per query: shuffles (hash / range / single-partition exchanges), broadcast
exchanges, whether filters were pushed to a parquet scan, Python evaluation
nodes, generators (explode) and windows.  Plans are AQE's *initial* plans
(before runtime re-planning), so a join AQE later turns into a broadcast
still shows as a shuffle join here.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans.catalog import queries  # noqa: E402
from tidewater.session import build_session  # noqa: E402

JOIN = re.compile(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[[^\]]*\], \[[^\]]*\], (\w+)")
SKIP_PREFIX = ("stream_",)
SKIP = {"micro_batch_trigger", "viewing_figures_stream", "grid_search", "ml_stages",
        "logistic_regression", "decision_tree", "random_forest", "kmeans", "kmeans_centers",
        "kmeans_cost", "silhouette", "als_recommend", "recs_with_history", "house_price_model",
        "retention_model", "trial_conversion_trees", "linear_regression"}


def summarise(plan: str) -> dict:
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "bcast": len(re.findall(r"BroadcastExchange", plan)),
        "joins": ", ".join(sorted({f"{a} {b}" for a, b in JOIN.findall(plan)})),
        "pushed": "yes" if re.search(r"PushedFilters: \[(?!\])", plan) else "-",
        "python": "yes" if re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas",
                                     plan) else "-",
        "explode": "yes" if "Generate" in plan else "-",
        "top-k": "yes" if re.search(r"TakeOrderedAndProject|WindowGroupLimit", plan) else "-",
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    print("# PLANS\n")
    print(f"Initial physical plans at `{sf}` (`tools/plan_report.py`). Counts are plan nodes: "
          "hash / range / single-partition shuffles and broadcast exchanges. *pushed*: a "
          "filter reached a parquet scan; *python*: a Python evaluation node; *top-k*: "
          "TakeOrderedAndProject or WindowGroupLimit. Model and streaming keys are not listed "
          "(their plans are Spark ML's and the streaming engine's).\n")
    print("| key | hash | range | single | bcast | joins | pushed | python | explode | top-k |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for key, fn in queries().items():
        if key in SKIP or key.startswith(SKIP_PREFIX):
            continue
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| `{key}` | {s['hash']} | {s['range']} | {s['single']} | {s['bcast']} | "
              f"{s['joins'] or '-'} | {s['pushed']} | {s['python']} | {s['explode']} | {s['top-k']} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
