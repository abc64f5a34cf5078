from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import relational as R
from tidewater.operators.pivot import pivot_agg
from tidewater.operators.stats import correlations
from tidewater.operators.text import remove_stop_words, tokenize, word_counts


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [("a", "x", 1, 10.0), ("a", "y", 2, 20.0), ("b", "x", 3, 30.0), ("a", "x", 4, None)],
        "k string, g string, n int, v double")


def test_grouping_operators(sales):
    assert rows(R.count_by(sales, "k", "c")) == [("a", 3), ("b", 1)]
    assert rows(R.sum_by(sales, ["k", "g"], "n", "s")) == [("a", "x", 5), ("a", "y", 2), ("b", "x", 3)]
    assert rows(R.sum_count_by(sales, "k", "n", "s", "c")) == [("a", 7, 3), ("b", 3, 1)]
    assert rows(R.avg_by(sales, "k", "v", "m")) == [("a", 15.0), ("b", 30.0)]
    assert rows(R.mean_and_count_by(sales, "k", "n", "m", "c")) == [("a", 3, 7 / 3), ("b", 1, 3.0)]
    assert rows(R.having(R.count_by(sales, "k", "c"), F.col("c") > 1)) == [("a", 3)]
    assert rows(R.max_mean_by(sales, "k", "n", "mx", "mn")) == [("a", 4, 7 / 3), ("b", 3, 3.0)]
    ms = {r["k"]: r for r in R.mean_stddev_by(sales, "k", "n").collect()}
    assert ms["a"]["std_dev"] == 1.53 and ms["b"]["std_dev"] is None
    assert R.global_sum(sales, "n", "t").first()["t"] == 10


def test_distinct_and_sorting(sales):
    assert rows(R.distinct_rows(sales, ["k", "g"])) == [("a", "x"), ("a", "y"), ("b", "x")]
    assert [r["k"] for r in R.distinct_sorted(sales, "k").collect()] == ["b", "a"]
    assert [r["n"] for r in R.sort_by(sales, "n", descending=True).collect()] == [4, 3, 2, 1]


def test_fill_zero_keeps_names_and_order(sales):
    out = R.fill_zero(sales, ["v"])
    assert out.columns == sales.columns
    assert sorted(r["v"] for r in out.collect()) == [0.0, 10.0, 20.0, 30.0]


def test_ratio_of_counts(sales):
    child = R.count_by(sales, ["k", "g"], "c")
    parent = R.count_by(sales, "k", "p")
    got = rows(R.ratio_of_counts(child, parent, "k", "c", "p"), "k", "g", "share")
    assert got == [("a", "x", 2 / 3), ("a", "y", 1 / 3), ("b", "x", 1.0)]


def test_lookup_left_and_strict(spark):
    fact = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id int, name string")
    assert rows(R.lookup(fact, dim, "id")) == [(1, "one"), (2, "two"), (3, None)]
    with pytest.raises(KeyError):
        R.lookup(fact, dim, "id", strict=True)
    assert R.lookup(fact.filter("id < 3"), dim, "id", strict=True).count() == 2


def test_pivot_explicit_values_and_names(sales):
    out = pivot_agg(sales, "k", "g", F.sum("n"), ["x", "y", "z"])
    assert out.columns == ["k", "x", "y", "z"]
    assert rows(out) == [("a", 5, 2, None), ("b", 3, None, None)]
    multi = pivot_agg(sales, "k", "g", {"s": F.sum("n"), "c": F.count(F.lit(1))}, ["x"])
    assert multi.columns == ["k", "x_s", "x_c"]


def test_correlations_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 3.0), (3.0, 6.0, 1.0)], "t double, a double, b double")
    got = dict(rows(correlations(df, "t", digits=6)))
    assert got == {"a": 1.0, "b": -1.0}


def test_stop_words_list_and_frame(spark):
    docs = spark.createDataFrame([(1, "The cat, the DOG and 3 birds!"), (2, "A dog")], "id int, text string")
    words = tokenize(docs, "text", keep=["id"])
    assert rows(words.filter("id = 2"), "word") == [("a",), ("dog",)]
    listed = rows(word_counts(remove_stop_words(words, "word", ["the", "and", "a"])))
    assert listed == [("birds", 1), ("cat", 1), ("dog", 2)]
    stops = spark.createDataFrame([("the",), ("and",), ("a",)], "w string")
    assert rows(word_counts(remove_stop_words(words, "word", stops))) == listed


def test_conditional_pivot_equals_native_pivot(spark, sales):
    specs = {"s": (F.sum, "n"), "c": (F.count, "v"), "m": (F.max, "v")}
    native = pivot_agg(sales, "k", "g", {"s": F.sum("n"), "c": F.count("v"), "m": F.max("v")},
                       ["x", "y", "z"])
    cond = pivot_agg(sales, "k", "g", specs, ["x", "y", "z"])
    assert cond.columns == native.columns
    assert rows(cond) == rows(native)
    # discovered values, single measure -> cells named by value only
    one = pivot_agg(sales, "k", "g", {"count": (F.count, F.lit(1))})
    assert one.columns == ["k", "x", "y"]
    assert rows(one) == [("a", 2, 1), ("b", 1, None)]


def test_conditional_pivot_is_one_aggregation(spark, sales):
    p = pivot_agg(sales, "k", "g", {"s": (F.sum, "n")}, ["x", "y"])
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_pivot_with_discovered_values_keeps_every_value_and_null(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "unlisted", 3), (None, "x", 4)],
                               "k string, g string, n int")
    one = pivot_agg(df, "k", "g", {"s": (F.sum, "n")})
    assert one.columns == ["k", "null", "unlisted", "x"]
    assert sorted(map(tuple, one.collect()), key=str) == sorted(
        [("a", 2, None, 1), ("b", None, 3, None), (None, None, None, 4)], key=str)
    many = spark.range(3000).select((F.col("id") % 3).alias("k"), (F.col("id") % 300).alias("g"), F.col("id").alias("n"))
    wide = pivot_agg(many, "k", "g", {"s": (F.sum, "n"), "c": (F.count, "n")})
    assert len(wide.columns) == 601 and wide.count() == 3


def test_accented_words_stay_whole(spark):
    df = spark.createDataFrame([("Für l'été señor ÖL 42 naïve",)], "text string")
    assert rows(tokenize(df, "text")) == sorted((w,) for w in ("für", "l", "été", "señor", "öl", "naïve"))


def test_no_job_runs_while_a_plan_is_built(spark, small_dir):
    from tidewater.plans.catalog import queries
    tracker = spark.sparkContext.statusTracker()
    for key in ("broadcast_lookup", "category_grouping", "ratio_of_counts", "course_popularity", "stopword_filter"):
        group = f"build-{key}"
        spark.sparkContext.setJobGroup(group, key)
        queries()[key](spark, small_dir)
        assert list(tracker.getJobIdsForGroup(group)) == []
    spark.sparkContext._jsc.clearJobGroup()
