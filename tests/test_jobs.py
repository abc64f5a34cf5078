"""End-to-end jobs on small inline fixtures with hand-computed answers."""
from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from tidewater.plans import jobs

# The course-popularity job's built-in test rows, (user, chapter)
# views and (chapter, course) pairs; expected scores by hand: course 2 -> 10,
# course 1 -> 6, course 3 -> 0.
VIEWS = [(14, 96), (14, 97), (13, 96), (13, 96), (13, 96), (14, 99), (13, 100)]
CHAPTERS = [(96, 1), (97, 1), (98, 1), (99, 2)] + [(c, 3) for c in range(100, 110)]
TITLES = [(1, "course one"), (2, "course two"), (3, "course three")]


def _course_inputs(spark, views=VIEWS, chapters=CHAPTERS, titles=TITLES):
    return (spark.createDataFrame(views, "user_id int, chapter_id int"),
            spark.createDataFrame(chapters, "chapter_id int, course_id int"),
            spark.createDataFrame(titles, "course_id int, title string"))


def test_course_popularity_fixture(spark):
    out = jobs.course_popularity(*_course_inputs(spark)).collect()
    assert [(r["score"], r["course_id"]) for r in out] == [(10, 2), (6, 1), (0, 3)]
    assert out[0]["title"] == TITLES[1][1]


def test_course_popularity_unknown_chapter_and_unviewed_course(spark):
    views = VIEWS + [(15, 999)]                      # chapter 999 does not exist
    chapters = CHAPTERS + [(200, 4)]                  # course 4 has no views
    titles = TITLES + [(4, "Nobody watched this")]
    out = jobs.course_popularity(*_course_inputs(spark, views, chapters, titles)).collect()
    assert sorted((r["course_id"], r["score"]) for r in out) == [(1, 6), (2, 10), (3, 0)]


def test_course_popularity_bands_are_strict(spark):
    # user 1 watches exactly half of course 1 (2 of 4 chapters): 0.5 is not > 0.5
    views = [(1, 1), (1, 2)]
    chapters = [(1, 1), (2, 1), (3, 1), (4, 1)]
    out = jobs.course_popularity(*_course_inputs(spark, views, chapters, [(1, "t")])).collect()
    assert out[0]["score"] == 2


# Five log rows (level, date-time; single-digit months in two).
LOG_ROWS = [("WARN", "2016-12-31 04:19:32"), ("FATAL", "2016-12-31 03:22:34"),
            ("WARN", "2016-12-31 03:21:21"), ("INFO", "2015-4-21 14:32:21"),
            ("FATAL", "2015-4-21 19:23:20")]


def test_log_level_by_month(spark):
    logs = spark.createDataFrame(LOG_ROWS, "level string, datetime string")
    out = jobs.log_level_by_month(logs).collect()
    assert out[0]["month"] == "April" and out[-1]["month"] == "December"
    assert sorted(tuple(r) for r in out) == sorted([("WARN", "December", 2), ("FATAL", "December", 1),
                                                    ("INFO", "April", 1), ("FATAL", "April", 1)])
    assert jobs.log_level_by_month(logs).columns == ["level", "month", "total"]


def test_lowest_rated_items_ties_names_and_threshold(spark):
    ratings = []
    for item, (rating, n) in {1: (2.0, 11), 2: (2.0, 11), 3: (1.0, 10), 4: (3.0, 12), 5: (1.5, 20)}.items():
        ratings += [(item, rating)] * n
    r = spark.createDataFrame(ratings, "item int, rating double")
    names = spark.createDataFrame([(1, "one"), (2, "two"), (4, "four")], "item int, name string")
    out = jobs.lowest_rated_items(r, names, k=3).orderBy("avg_rating", "item").collect()
    # item 3 has only 10 ratings (not > 10); item 5 has no name -> null
    assert [(x["item"], x["name"], x["n_ratings"]) for x in out] == [(5, None, 20), (1, "one", 11),
                                                                   (2, "two", 11)]


def test_exam_stats_pivot_names_and_single_row_group(spark):
    data = [("Math", "2005", "80"), ("Math", "2005", "90"), ("Math", "2006", "70"),
            ("Art", "2005", "60")]
    df = spark.createDataFrame(data, "subject string, year string, score string")
    out = jobs.exam_stats_pivot(df)
    assert out.columns == ["subject", "2005_avg", "2005_std_dev", "2006_avg", "2006_std_dev"]
    got = {r["subject"]: r for r in out.collect()}
    assert got["Math"]["2005_avg"] == 85.0 and got["Math"]["2005_std_dev"] == 7.07
    assert got["Math"]["2006_std_dev"] is None            # one row: sample std-dev is null
    assert got["Art"]["2006_avg"] is None                  # absent cell


def test_price_correlation_report_excludes_target_and_dropped(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 1, "x"), (2.0, 4.0, 1.0, 2, "y"), (3.0, 6.5, 2.0, 3, "z")],
                               "price double, a double, b double, id int, s string")
    out = {r["feature"]: r["corr"] for r in jobs.price_correlation_report(df, "price", drop=["id"]).collect()}
    assert set(out) == {"a", "b"}
    assert out["a"] > 0.99


def test_attach_to_few_keeps_rows_without_match(spark):
    few = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    dim = spark.createDataFrame([(1, "a"), (3, "c")], "k int, name string")
    assert rows(jobs.attach_to_few(few, dim, "k"), "k", "name") == [(1, "a"), (2, None)]


def test_jobs_on_empty_inputs(spark):
    views, chapters, titles = _course_inputs(spark)
    empty_views = views.limit(0)
    assert jobs.course_popularity(empty_views, chapters, titles).count() == 0
    r = spark.createDataFrame([], "item int, rating double")
    n = spark.createDataFrame([], "item int, name string")
    assert jobs.lowest_rated_items(r, n).count() == 0
    logs = spark.createDataFrame([], "level string, datetime string")
    assert jobs.log_level_by_month(logs).count() == 0


def test_top_k_ties_at_the_boundary_are_broken_by_key(spark):
    from tidewater.operators.relational import top_k, top_k_per_group
    df = spark.createDataFrame([(i, 1.0 if i < 6 else 2.0) for i in range(10)], "id int, v double")
    got = [r["id"] for r in top_k(df, 3, [F.col("v").asc(), F.col("id").desc()]).collect()]
    assert got == [5, 4, 3]
    g = df.withColumn("g", F.col("id") % 2)
    per = top_k_per_group(g, "g", [F.col("v").asc(), F.col("id").asc()], 2)
    assert sorted((r["g"], r["id"], r["rank"]) for r in per.collect()) == [
        (0, 0, 1), (0, 2, 2), (1, 1, 1), (1, 3, 2)]
