"""Property checks on random inputs: rewrites equal the plain Spark forms."""
from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.functions.columns import DEFAULT_BANDS, band_score
from tidewater.operators.pivot import pivot_agg
from tidewater.operators.windows import sliding_sum, window_agg

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])
BASE = dt.datetime(2024, 1, 1)
SMALL = settings(SETTINGS, max_examples=8)

events = st.lists(st.tuples(st.integers(-3_600, 20_000), st.sampled_from("abc"),
                            st.integers(1, 9)), min_size=1, max_size=60)
shapes = st.sampled_from([(60, 10), (120, 2), (300, 60), (90, 30), (600, 600)])


@SETTINGS
@given(rows=events, shape=shapes)
def test_sliding_sum_equals_window_expand(spark, rows, shape):
    d, s = shape
    data = [(BASE + dt.timedelta(seconds=t), k, v) for t, k, v in rows]
    df = spark.createDataFrame(data, "ts timestamp_ntz, k string, v int")
    a = sliding_sum(df, "ts", "k", f"{d} seconds", f"{s} seconds", F.col("v"), "total")
    b = window_agg(df, "ts", "k", f"{d} seconds", f"{s} seconds", {"total": F.sum("v")})
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from("xyz"), st.sampled_from(["p", "q", "r", None]),
                               st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=40))
def test_conditional_pivot_equals_native(spark, rows):
    df = spark.createDataFrame(rows, "g string, p string, v int")
    values = ["p", "q", "r", "s"]
    native = pivot_agg(df, "g", "p", {"sum": F.sum("v"), "cnt": F.count("v"), "mx": F.max("v")},
                       values)
    cond = pivot_agg(df, "g", "p", {"sum": (F.sum, "v"), "cnt": (F.count, "v"), "mx": (F.max, "v")},
                     values)
    assert cond.columns == native.columns
    assert sorted(map(tuple, cond.collect())) == sorted(map(tuple, native.collect()))


def _band(r):
    if r is None:
        return 0
    for bound, score in DEFAULT_BANDS:
        if r > bound:
            return score
    return 0


@SETTINGS
@given(ratios=st.lists(st.one_of(st.none(), st.sampled_from([0.25, 0.5, 0.9]),
                                 st.floats(-1, 2, allow_nan=False)), min_size=1, max_size=30))
def test_band_score_matches_rule(spark, ratios):
    df = spark.createDataFrame([(r,) for r in ratios], "r double")
    got = [x[0] for x in df.select(band_score("r")).collect()]
    assert got == [_band(r) for r in ratios]


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from("xyz"), st.sampled_from(["p", "q", "r", None]),
                               st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=40))
def test_discovered_pivot_equals_native(spark, rows):
    df = spark.createDataFrame(rows, "g string, p string, v int")
    native = df.groupBy("g").pivot("p").agg(F.sum("v").alias("sum"), F.count("v").alias("cnt"))
    ours = pivot_agg(df, "g", "p", {"sum": (F.sum, "v"), "cnt": (F.count, "v")})
    assert ours.columns == native.columns
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, native.collect()))


def _course_popularity_brute(views, chapters, titles):
    course_of = dict(chapters)
    size = {}
    for _, c in chapters:
        size[c] = size.get(c, 0) + 1
    watched = {}
    for u, ch in set(views):
        if ch in course_of:
            key = (u, course_of[ch])
            watched[key] = watched.get(key, 0) + 1
    score = {}
    for (u, c), n in watched.items():
        r = n / size[c]
        s = 10 if r > 0.9 else 4 if r > 0.5 else 2 if r > 0.25 else 0
        score[c] = score.get(c, 0) + s
    names = dict(titles)
    return sorted((c, names[c], s) for c, s in score.items() if c in names)


@SMALL
@given(views=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 14)), max_size=40),
       sizes=st.lists(st.integers(1, 5), min_size=1, max_size=4))
def test_course_popularity_equals_brute_force(spark, views, sizes):
    from tidewater.plans import jobs
    chapters, ch = [], 0
    for course, n in enumerate(sizes):
        for _ in range(n):
            chapters.append((ch, course))
            ch += 1
    titles = [(c, f"t{c}") for c in range(len(sizes)) if c != 1]       # course 1 has no title
    got = jobs.course_popularity(
        spark.createDataFrame(views, "user_id int, chapter_id int"),
        spark.createDataFrame(chapters, "chapter_id int, course_id int"),
        spark.createDataFrame(titles, "course_id int, title string")).collect()
    assert sorted(tuple(r) for r in got) == _course_popularity_brute(views, chapters, titles)


@SMALL
@given(ratings=st.lists(st.tuples(st.integers(0, 6), st.integers(1, 5)), max_size=80),
       min_count=st.integers(0, 4), k=st.integers(1, 4))
def test_lowest_rated_items_equals_brute_force(spark, ratings, min_count, k):
    from tidewater.plans import jobs
    names = [(i, f"n{i}") for i in range(0, 7, 2)]                  # odd items unnamed
    got = jobs.lowest_rated_items(spark.createDataFrame(ratings, "item int, rating int"),
                                  spark.createDataFrame(names, "item int, name string"),
                                  min_count=min_count, k=k).collect()
    per = {}
    for i, r in ratings:
        per.setdefault(i, []).append(r)
    stats = sorted(((sum(v) / len(v), i, len(v)) for i, v in per.items() if len(v) > min_count))[:k]
    want = [(i, dict(names).get(i), n, avg) for avg, i, n in stats]
    assert [tuple(r) for r in got] == want


@SMALL
@given(rows=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 20), st.integers(0, 3)),
                     min_size=1, max_size=50), k=st.integers(1, 3))
def test_top_k_per_group_equals_brute_force(spark, rows, k):
    from tidewater.operators.relational import top_k_per_group
    df = spark.createDataFrame([(g, i, v) for i, (g, _, v) in enumerate(rows)], "g string, id int, v int")
    got = top_k_per_group(df, "g", [F.col("v").desc(), F.col("id").asc()], k)
    want = []
    for g in sorted({r[0] for r in rows}):
        items = sorted(((-v, i) for i, (gg, _, v) in enumerate(rows) if gg == g))[:k]
        want += [(g, i, -nv, rank + 1) for rank, (nv, i) in enumerate(items)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
