"""The model programs on small generated CSV files."""
from __future__ import annotations

import random

import pytest

from tidewater.plans import model_programs as P
from tidewater.session import scratch_path


def _csv(spark, schema, data, name):
    path = scratch_path(spark, name)
    spark.createDataFrame(data, schema).coalesce(1).write.option("header", True).csv(path)
    return path


def test_house_prices(spark):
    rng = random.Random(1)
    data = []
    for i in range(300):
        living = rng.randint(600, 4000)
        data.append((float(150 * living + 1000 * (i % 5)), rng.randint(1, 5), 1.5, living, living - 100, 2.0,
                     i % 2, 1 + i % 3, 5 + i % 4, 98000 + i % 3))
    path = _csv(spark, "price double, bedrooms int, bathrooms double, sqft_living int, sqft_above int, floors double, "
                       "waterfront int, condition int, grade int, zipcode int", data, "houses")
    report, pred = P.house_prices_from_csv(spark, path)
    rows = {r["split"]: r for r in report.collect()}
    assert rows["train"]["n"] + rows["holdout"]["n"] == 300 and rows["holdout"]["r2"] > 0.9
    assert pred.count() == rows["holdout"]["n"]


@pytest.fixture(scope="module")
def views(spark):
    rng = random.Random(2)
    data = []
    for i in range(400):
        last = rng.randint(0, 50)
        data.append(("2020-01-01", i % 4 != 0, i % 3 if i % 5 else None, 20 + i % 40, last * 3, last,
                     last // 2 if last > 20 else 0, "card" if i % 2 else "other", ("GB", "US", "FR")[i % 3], 1 + i % 2))
    return _csv(spark, "observation_date string, is_cancelled boolean, firstSub int, age int, all_time_views int, "
                       "last_month_views int, next_month_views int, payment_method_type string, country string, "
                       "rebill_period_in_months int", data, "views")


def test_retention_and_forecast(spark, views):
    table, summary = P.retention_from_csv(spark, views)
    n = sum(r["count"] for r in table.collect())
    assert 10 <= n <= 60 and summary.head().accuracy > 0.6
    pred = P.views_forecast_from_csv(spark, views).collect()
    assert len(pred) == n and all(abs(r.label - r.prediction) < 25 for r in pred)


def test_trial_trees(spark):
    rng = random.Random(3)
    data = [(rng.choice(("GB", "FR", "JP", "US")), 1 + i % 2, rng.randint(0, 30), 60 * (i % 50), int(i % 50 > 25))
            for i in range(300)]
    path = _csv(spark, "country string, rebill_period int, chapter_access_count int, seconds_watched int, "
                       "payments_made int", data, "trials")
    report = {r.model: r.accuracy for r in P.trial_trees_from_csv(spark, path).collect()}
    assert set(report) == {"decision_tree", "random_forest"} and min(report.values()) > 0.8


def test_gym_reports(spark):
    data = [("MF"[i % 2], 20 + i % 30, 150 + i % 40, 50 + i % 50, 10 + 2 * (i % 30) + 5 * (i % 2)) for i in range(200)]
    path = _csv(spark, "Gender string, Age int, Height int, Weight int, NoOfReps int", data, "gym")
    sizes = P.gym_clusters_from_csv(spark, path, 3).collect()
    assert sum(r["size"] for r in sizes) == 200 and len(sizes) == 3
    ols = {r.position: r.coefficient for r in P.repetitions_from_csv(spark, path).collect()}
    assert ols[1] == pytest.approx(2.0, abs=1e-3)


def test_recommendations(spark):
    data = [(u, c, ((u * c) % 5 + 1) / 10) for u in range(6) for c in range(8) if (u + c) % 3]
    path = _csv(spark, "userId int, courseId int, proportionWatched double", data, "watched")
    rows = P.recommendations_from_csv(spark, path, [1, 4], 3).collect()
    assert sorted((r.userId, r.kind) for r in rows if r.kind == "recommended") == [(1, "recommended")] * 3 + [(4, "recommended")] * 3
    assert {r.item if hasattr(r, "item") else r.courseId for r in rows if r.userId == 1 and r.kind == "watched"} == {
        c for u, c, _ in data if u == 1}
