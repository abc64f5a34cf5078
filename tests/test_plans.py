"""Plan-shape checks: pushdown, pruning, top-k operators, no cartesian
products, bounded broadcasts, single-pass aggregates."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewater.operators.windows import sliding_sum
from tidewater.plans.catalog import queries


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, small_dir):
    p = plan(queries()["filter_sql_text"](spark, small_dir))
    pushed = p[p.index("PushedFilters: ["):]
    assert "EqualTo(o_orderstatus,F)" in pushed and "GreaterThanOrEqual(o" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," in p
    assert "o_orderpriority" not in p


def test_projection_pruned_at_scan(spark, small_dir):
    p = plan(queries()["count_by_composite_key"](spark, small_dir))
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string>" in p


def test_top_k_is_take_ordered(spark, small_dir):
    assert "TakeOrderedAndProject" in plan(queries()["top_k"](spark, small_dir))


def test_top_k_per_window_limits_before_shuffle(spark, small_dir):
    p = plan(queries()["top_k_per_window"](spark, small_dir))
    assert "WindowGroupLimit" in p and "Partial" in p


BATCH_KEYS = [k for k in queries() if not k.startswith("stream") and k not in {
    "viewing_figures_stream", "grid_search", "ml_stages", "logistic_regression", "decision_tree",
    "random_forest", "kmeans", "kmeans_centers", "kmeans_cost", "silhouette", "als_recommend",
    "recs_with_history", "house_price_model", "retention_model", "trial_conversion_trees",
    "linear_regression"}]


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_cartesian_products(spark, small_dir, key):
    p = queries()[key](spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in p and "Join Cross" not in p
    sp = plan(queries()[key](spark, small_dir))
    assert "BroadcastNestedLoopJoin" not in sp and "CartesianProduct" not in sp


def test_course_popularity_never_deals_user_rows_by_course(spark):
    """A course that a third of all views belong to: only per-level counts are dealt by course."""
    from tidewater.plans.jobs import course_popularity
    views = spark.range(30000).select((F.col("id") % 1000).alias("user_id"),
                                      F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("chapter_id"))
    chapters = spark.range(40).select(F.col("id").alias("chapter_id"), (F.col("id") % 8).alias("course_id"))
    titles = spark.range(8).select(F.col("id").alias("course_id"), F.col("id").cast("string").alias("title"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = course_popularity(views, chapters, titles)
        p = plan(out)
        assert out.count() == 8
        # users appear only in exchanges keyed by user and chapter, by chapter, or by user and course
        for line in p.splitlines():
            if "Exchange hashpartitioning(course_id" in line:
                assert "user_id" not in line
        before = p.split("functions=[partial_count(1)]")
        assert any("n_watched" in x for x in before)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sliding_sum_pre_aggregates_before_fan_out(spark):
    df = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 7).alias("ts"),
                                  (F.col("id") % 3).alias("k"))
    p = sliding_sum(df, "ts", "k", "10 minutes", "1 minute", None, "n")._jdf.queryExecution() \
        .optimizedPlan().toString()
    gen, agg = p.find("Generate explode"), p.rfind("Aggregate")
    assert gen != -1 and agg > gen          # an aggregate runs below (before) the explode


def test_sliding_sum_equals_window_expand(spark):
    from tidewater.operators.windows import window_agg
    df = spark.range(500).select(F.timestamp_seconds(F.col("id") * 37).alias("ts"),
                                 (F.col("id") % 4).alias("k"))
    a = sliding_sum(df, "ts", "k", "10 minutes", "2 minutes", None, "n")
    b = window_agg(df, "ts", "k", "10 minutes", "2 minutes", {"n": F.count(F.lit(1))})
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_correlation_is_one_aggregate(spark, small_dir):
    p = plan(queries()["pearson_corr"](spark, small_dir))
    assert p.count("HashAggregate") <= 2 and "Exchange SinglePartition" in p


def test_event_on_window_edge_belongs_to_next_window(spark):
    import datetime as dt
    from tidewater.operators.windows import window_agg
    t0 = dt.datetime(2024, 1, 1, 10, 2, 0)
    df = spark.createDataFrame([(t0, "a")], "ts timestamp_ntz, k string")
    tumble = window_agg(df, "ts", "k", "2 minutes", None, {"n": F.count(F.lit(1))}).first()
    assert tumble["window_start"] == t0 and tumble["window_end"] == dt.datetime(2024, 1, 1, 10, 4)
    slid = sliding_sum(df, "ts", "k", "4 minutes", "2 minutes", None, "n").collect()
    assert sorted(r["window_start"] for r in slid) == [dt.datetime(2024, 1, 1, 10, 0), t0]


def test_sliding_sum_falls_back_when_slide_does_not_divide(spark):
    from tidewater.operators.windows import window_agg
    df = spark.range(200).select(F.timestamp_seconds(F.col("id") * 41).alias("ts"),
                                 (F.col("id") % 2).alias("k"))
    a = sliding_sum(df, "ts", "k", "5 minutes", "2 minutes", None, "n")
    b = window_agg(df, "ts", "k", "5 minutes", "2 minutes", {"n": F.count(F.lit(1))})
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_sliding_sum_final_aggregate_needs_no_third_shuffle(spark, small_dir):
    p = plan(queries()["sliding_window_60m_1m"](spark, small_dir))
    assert p.count("Exchange hashpartitioning") == 2
    final = p[:p.index("Generate explode(")]
    assert "Exchange" not in final           # windows summed where the chunk already is


def test_hot_join_key_is_split_by_aqe(spark):
    """One key holds a third of the fact rows: AQE's skew join splits it."""
    from tidewater.operators.relational import inner_join
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(60_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("k"),
            F.col("id").alias("v"))
        dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = inner_join(fact, dim, "k")
        n = len(joined.collect())                      # runs this plan (AQE final plan)
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final and "skew=true" in final
        assert n == 60_000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
