"""The conditions of the model queries: met by the fits, broken by models put in their place."""
from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewater.operators import features as FE
from tidewater.operators import models as M
from tidewater.plans import queries_ml as Q


@pytest.fixture(scope="module")
def points(spark):
    rows = spark.range(3000).select(
        "id", (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000).alias("a"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 10).alias("b"), F.lit(3.0).alias("same"))
    noise = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1000)) / 500
    rows = rows.withColumn("label", 2 * F.col("a") - 0.05 * F.col("b") + noise)
    return FE.assemble(rows, ["a", "b", "same"]).cache()


@pytest.mark.parametrize("reg, net", [(0.0, 0.0), (0.3, 0.0), (0.1, 0.5), (0.05, 1.0), (50.0, 1.0)])
def test_linear_optimum(points, reg, net):
    model = M.linear_regression(reg_param=reg, elastic_net=net).fit(points)
    assert M.optimality_gap(model, points) < Q.NEAR
    other = M.linear_regression(reg_param=reg, elastic_net=net).fit(points.withColumn("label", F.lit(1.0) + F.col("b") % 7))
    assert M.optimality_gap(other, points) > 100 * Q.NEAR


@pytest.mark.parametrize("reg, net", [(0.0, 0.0), (0.1, 0.0), (0.02, 0.5), (0.01, 1.0), (5.0, 1.0)])
def test_logistic_optimum(points, reg, net):
    binary = points.withColumn("label", (F.col("label") > 1).cast("double"))
    learner = M.logistic_regression().setRegParam(reg).setElasticNetParam(net)
    assert M.optimality_gap(learner.fit(binary), binary) < Q.NEAR
    other = learner.fit(binary.withColumn("label", (F.col("b") > 90).cast("double")))
    assert M.optimality_gap(other, binary) > 100 * Q.NEAR


def test_one_cut_and_brier_against_python(points):
    binary = points.withColumn("label", (F.col("label") > 1).cast("double"))
    rows = binary.select("a", "label").collect()
    mean = sum(r.a for r in rows) / len(rows)
    want = 0.0
    for side in ([r.label for r in rows if r.a > mean], [r.label for r in rows if r.a <= mean]):
        p = sum(side) / len(side)
        want += sum((y - p) ** 2 for y in side) / len(rows)
    assert M.one_cut_brier(binary, "a") == pytest.approx(want)
    tree = M.decision_tree(3).fit(binary)
    got = [(float(r.probability[1]) - r.label) ** 2 for r in tree.transform(binary).collect()]
    assert M.brier_score(tree.transform(binary)) == pytest.approx(sum(got) / len(got))
    assert M.brier_score(tree.transform(binary)) < want < M.brier_score(M.decision_tree(0).fit(binary).transform(binary))


def test_squares_and_distances_against_python(points):
    model = M.kmeans(3).fit(points)
    rows = M.center_distances(model.transform(points), model).select(
        vector_to_array("features").alias("x"), "distances", "prediction").collect()
    centers = [list(c) for c in model.clusterCenters()]
    for r in rows[:50]:
        assert r.distances == pytest.approx([sum((a - b) ** 2 for a, b in zip(r.x, c)) for c in centers])
    means = [sum(r.x[j] for r in rows) / len(rows) for j in range(3)]
    assert M.total_squares(points) == pytest.approx(sum((r.x[j] - means[j]) ** 2 for r in rows for j in range(3)))


def _alike(data):
    return data.withColumn("label", F.when(F.hash("features") % 2 == 0, 1.0).otherwise(0.0))


def test_a_tree_that_learned_nothing_turns_the_rows_red(spark, small_dir, monkeypatch):
    tree, forest = M.decision_tree, M.random_forest
    monkeypatch.setattr(M, "decision_tree", lambda depth, seed=42: tree(0, seed))
    monkeypatch.setattr(M, "random_forest", lambda depth, seed=42: forest(0, seed))
    assert not any(r.scored for r in Q.q_decision_tree(spark, small_dir).collect())
    assert not any(r.scored for r in Q.q_random_forest(spark, small_dir).collect())
    assert [r.learned for r in Q.q_trial_conversion_trees(spark, small_dir).collect()] == [False, False]


def test_a_wrong_regression_turns_the_rows_red(spark, small_dir, monkeypatch):
    tune, stages = M.tune, M.fit_stages
    monkeypatch.setattr(M, "tune", lambda e, g, ev, train, *a: tune(e, g, ev, _alike(train), *a))
    monkeypatch.setattr(Q.MJ.M, "fit_stages", lambda s, train: stages(
        s, train if s[-1].__class__.__name__ != "TrainValidationSplit" else train.withColumn("label", F.lit(2.0) + F.rand(1))))
    assert not any(r.optimal for r in Q.q_grid_search(spark, small_dir).collect())
    assert not any(r.scored for r in Q.q_logistic_regression(spark, small_dir).collect())
    assert not any(r.optimal for r in Q.q_retention_model(spark, small_dir).collect())
    assert not any(r.scored for r in Q.q_ml_stages(spark, small_dir).collect())
    assert not any(r.fitted for r in Q.q_house_price_model(spark, small_dir).collect())
    assert not any(r.scored for r in Q.q_views_forecast(spark, small_dir).collect())


def test_wrong_centres_and_factors_turn_the_rows_red(spark, small_dir, monkeypatch):
    kmeans, als = M.kmeans, M.als

    class Elsewhere:
        def __init__(self, learner):
            self.learner = learner

        def fit(self, data):
            """Centres of other rows."""
            far = FE.array_column_to_vector(data.select(F.transform(
                vector_to_array("features"), lambda v: v * 1.5 + 1).alias("x")), "x", "features")
            return self.learner.fit(far)

    monkeypatch.setattr(M, "kmeans", lambda *a, **k: Elsewhere(kmeans(*a, **k)))
    row = Q.q_kmeans(spark, small_dir).head()
    assert not row.closer
    assert not all(r.settled for r in Q.q_kmeans_centers(spark, small_dir).collect())
    report = Q.q_clustering_report(spark, small_dir).head()
    assert not (report.cost_holds and report.closer)
    monkeypatch.setattr(M, "als", lambda *a, **k: als(*a, max_iter=0, **k))
    assert not any(r.fitted for r in Q.q_als_recommend(spark, small_dir).collect())
    assert all(r.score == 0 for r in Q.q_recs_with_history(spark, small_dir).where("kind = 'recommended'").collect())


def test_grid_of_linear_models_does_not_read_the_rows_per_point(spark, points, monkeypatch):
    """Nine points: one fit, that of the best; the metrics are those of a fit and evaluation per point."""
    from pyspark.ml.evaluation import RegressionEvaluator
    fits, fit = [], M.LinearRegression._fit
    lr = M.linear_regression()
    grid, judge = M.grid(lr, (0.01, 0.1, 0.5), (0.0, 0.5, 1.0)), RegressionEvaluator(metricName="r2")
    monkeypatch.setattr(M.LinearRegression, "_fit", lambda self, data: fits.append(1) or fit(self, data))
    slim = []
    keep = M.written
    monkeypatch.setattr(M, "written", lambda df, name: slim.append(keep(df, name)) or slim[-1])
    tuned = M.tune(lr, grid, judge, points, 0.8, 42)
    assert len(fits) == 1 and len(tuned.validationMetrics) == 9
    train, held = slim[0].where("_part < 0.8"), slim[0].where("_part >= 0.8")
    assert train.count() + held.count() == points.count() and held.count() > 400
    want = [judge.evaluate(lr.fit(train, p).transform(held)) for p in grid]
    assert tuned.validationMetrics == pytest.approx(want, abs=1e-5)
    best = want.index(max(want))
    assert tuned.bestModel.getRegParam() == grid[best][lr.regParam]


def test_optimality_gap_is_one_pass_over_sparse_rows(spark, monkeypatch):
    """One-hot rows: no row per feature, and the gap of the definition."""
    from pyspark.ml.linalg import Vectors
    rows = [(float(i % 7 + (i % 3)), Vectors.sparse(6, [(i % 5, 1.0), (5, float(i % 11))])) for i in range(200)]
    df = spark.createDataFrame(rows, ["label", "features"])
    model = M.linear_regression(reg_param=0.2).fit(df.withColumn("label", F.col("label") * 2))
    monkeypatch.setattr(F, "posexplode", None)
    import numpy as np
    y, x = np.array([r[0] for r in rows]), np.array([r[1].toArray() for r in rows])
    r = y - x @ model.coefficients.toArray() - model.intercept
    sx, sy = x.std(axis=0, ddof=1), y.std(ddof=1)
    w = model.coefficients.toArray() * sx / sy
    slope = ((x - x.mean(axis=0)) * r[:, None]).mean(axis=0) / (sx * sy) - 0.2 / sy * w
    assert M.optimality_gap(model, df) == pytest.approx(max(abs(r.mean()) / sy, np.abs(slope).max()), rel=1e-9)


def test_recommendations_are_searched_once(spark, small_dir):
    """What checks the scores and what is returned read the search's rows, they do not search again."""
    recs, fits = Q._recommended(Q._ratings(spark, small_dir))
    plan = recs._jdf.queryExecution().optimizedPlan().toString()
    assert fits and "Join" not in plan and "MapPartitions" not in plan
    assert recs.count() == 5 * recs.select("user_id").distinct().count() > 0


def test_blocks_of_the_fit_follow_the_ratings(spark, monkeypatch):
    """Ten blocks up to their size, then as many as the ratings fill: a task's share does not grow with the table."""
    made, als = [], M.als
    monkeypatch.setattr(M, "als", lambda *a, **k: made.append(als(*a, **k)) or made[-1])
    ratings = spark.range(3000).selectExpr("id % 60 as u", "id * 7 % 41 as i", "cast(id * id % 9 as double) as r").groupBy(
        "u", "i").agg(F.max("r").alias("r"))
    n, splits = ratings.count(), spark.conf.get("spark.sql.files.maxPartitionBytes")
    errors = []
    for size, blocks, every in ((n, 10, 5), (n // 25 + 1, 25, 1)):
        monkeypatch.setattr(M, "BLOCK_RATINGS", size)
        fitted = M.rating_model(ratings, "u", "i", "r", max_iter=4)
        learner = made.pop()
        assert (learner.getNumUserBlocks(), learner.getNumItemBlocks(), learner.getCheckpointInterval()) == (blocks, blocks, every)
        errors.append(M.rating_errors(fitted, "r")[0])
        for side, many in ((fitted.model.userFactors, 60), (fitted.model.itemFactors, 41)):
            assert side.count() == many
            plan = side._jdf.queryExecution().executedPlan().toString()
            assert "FileScan" in plan and "ExistingRDD" not in plan           # the fit's shuffles can go
    assert errors[1] == pytest.approx(errors[0], rel=0.2)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == splits


@pytest.mark.parametrize("size", [1 << 22, 300, 7])
def test_rating_errors_by_tiles_against_numpy(spark, monkeypatch, size):
    """One tile or many, also such without ratings: the errors of every rating, without a join on the factors."""
    import numpy as np
    monkeypatch.setattr(M, "TILE_RATINGS", size)
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(70, 3)).astype(np.float32), rng.normal(size=(40, 3)).astype(np.float32)
    at = [(i, j, float((i * j) % 7)) for i in range(70) for j in range(40) if (i + 3 * j) % 4 == 0 and i < 60]

    def frame(m):
        return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "id int, features array<float>")

    numbered = spark.createDataFrame(at, "user_no int, item_no int, stars float")
    fitted = M.RatingModel(M.Factors(frame(u), frame(v)), None, None, numbered)
    e = [r - float(u[i].astype(float) @ v[j].astype(float)) for i, j, r in at]
    want = np.sqrt(np.mean(np.square(e))), np.std([r for *_, r in at])
    assert M.rating_errors(fitted, "stars") == pytest.approx(want, rel=1e-9)
    assert M.rating_errors(fitted._replace(numbered=numbered.where("false")), "stars") == (0.0, 0.0)


def test_every_user_is_served(spark, small_dir):
    """No user is left out, and each gets the best items of all by the fitted factors."""
    import numpy as np
    ratings = Q._ratings(spark, small_dir)
    everyone = {r.user_id for r in ratings.select("user_id").distinct().collect()}
    got = Q.q_als_recommend(spark, small_dir).collect()
    assert sorted(r.user_id for r in got) == sorted(everyone) and any(r.user_id % 50 for r in got)
    assert all(r.n_items == 5 and r.fitted for r in got)
    fitted = M.rating_model(ratings, "user_id", "item_id", "rating", max_iter=2)
    rows = M.recommend(fitted, None, "user_id", "item_id", 5).collect()
    keys = [{r[1]: r[0] for r in side.collect()} for side in (fitted.users, fitted.items)]
    u, v = ({keys[at][r.id]: np.array(r.features, dtype=float) for r in side.collect()}
            for at, side in enumerate(fitted.model))
    assert len(rows) == 5 * len(everyone) and u.keys() == everyone
    for r in rows:
        assert r.score == pytest.approx(float(u[r.user_id] @ v[r.item_id]), abs=1e-5)
        assert r.score == pytest.approx(sorted((float(u[r.user_id] @ x) for x in v.values()), reverse=True)[r["rank"] - 1], abs=1e-5)


@pytest.mark.parametrize("query", ["als_recommend", "recommend_all_users"])
def test_queries_of_all_users_hold_in_many_blocks(spark, small_dir, monkeypatch, query):
    """The query's own fit follows the ratings, and its conditions hold with many blocks and tiles."""
    made, als = [], M.als
    monkeypatch.setattr(M, "als", lambda *a, **k: made.append(als(*a, **k)) or made[-1])
    monkeypatch.setattr(M, "BLOCK_RATINGS", 400)
    monkeypatch.setattr(M, "TILE_RATINGS", 500)
    got = getattr(Q, f"q_{query}")(spark, small_dir).collect()
    assert made[0].getNumUserBlocks() == made[0].getNumItemBlocks() > 10
    assert len({r.user_id for r in got}) == len(got) > 100 and all(r.n_items == 5 and r[2] for r in got)
