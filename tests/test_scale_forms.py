"""The forms for large inputs against plain ones: shared statistics, exact search, ranks, sums, buckets."""
from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans  # noqa: F401  (the session needs Spark ML on its path)
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import features as FE
from tidewater.operators import models as M
from tidewater.operators import recommend as RC
from tidewater.operators import relational as R
from tidewater.operators import tuning as TU
from tidewater.operators.pivot import sparse_pivot


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3)) * [1.0, 20.0, 0.1] + [5.0, 0.0, 100.0]
    y = 3 * x[:, 0] - 0.2 * x[:, 1] + 7 * x[:, 2] + rng.normal(size=400)
    data = [(*map(float, r), 4.0, float(v), int(i % 5 == 0)) for i, (r, v) in enumerate(zip(x, y))]
    data += [(None, 1.0, 1.0, 4.0, 2.0, 0), (float("nan"), 1.0, 1.0, 4.0, 2.0, 1)]
    return spark.createDataFrame(data, "a double, b double, c double, constant double, y double, fold int")


def test_grid_from_moments_equals_spark_ml(spark, regression):
    cols = ["a", "b", "c", "constant"]
    report = TU.grid_from_moments(regression, cols, "y", "fold", (0.0, 0.01, 0.5), (0.0, 0.5, 1.0)).collect()
    clean = regression.where("a is not null and not isnan(a)").withColumnRenamed("y", "label")
    data = FE.assemble(clean, cols)
    train, held = data.where("fold = 0"), data.where("fold = 1")
    for row in report:
        lr = M.linear_regression().copy()
        lr.setRegParam(row.reg_param).setElasticNetParam(row.elastic_net).setMaxIter(500).setTol(1e-12)
        want = M.regression_metrics(lr.fit(train).transform(held)).head().r2
        assert row.r2 == pytest.approx(want, abs=2e-4)
    assert sum(r.chosen for r in report) == 1 and max(report, key=lambda r: r.r2).chosen


def test_grid_reads_its_input_once_and_takes_empty_ones(regression):
    assert TU.grid_from_moments(regression.where("fold = 0"), ["a"], "y", "fold", (0.1,), (0.0,)).collect() == []
    one = TU.fold_moments(regression, ["a", "b"], "y", "fold")
    assert {k: v.n for k, v in one.items()} == {0: 320, 1: 80}


@pytest.mark.parametrize("segment", [7, 1000])
def test_best_items_equal_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(RC, "BLOCK", 3)
    rng = np.random.default_rng(4)
    u, v = rng.normal(size=(60, 4)), rng.normal(size=(90, 4)) * rng.exponential(size=(90, 1))
    v[50:55] = v[49]                                  # ties: the smaller id first
    u[3] = 0.0
    frame = lambda m: spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)],
                                            "id bigint, features array<double>")
    got = sorted((r.id, r["rank"], r.item) for r in RC.top_items_for_all(frame(u), frame(v), 5, segment).collect())
    s = np.round(u @ v.T, 9)
    want = [(i, k + 1, int(j)) for i in range(60) if i != 3 for k, j in enumerate(np.lexsort((np.arange(90), -s[i]))[:5])]
    assert [x for x in got if x[0] != 3] == want
    assert len([x for x in got if x[0] == 3]) == 5
    few = RC.top_items_for_all(frame(u), frame(v[:2]), 5).groupBy("id").count().collect()
    assert len(few) == 60 and all(r["count"] == 2 for r in few)
    assert RC.top_items_for_all(frame(u), frame(v).where("false")).count() == 0
    assert RC.top_items_for_all(frame(u).where("false"), frame(v)).count() == 0


def test_rank_index_equals_the_indexer_on_many_values(spark):
    df = spark.range(3000).selectExpr("id", "concat('v', cast(pmod(hash(id), 700) as string)) as s")
    df = df.unionByName(spark.sql("select -1L as id, cast(null as string) as s"))
    got = FE.index_by_frequency(df, "s", "i")
    want = StringIndexer(inputCol="s", outputCol="i", stringOrderType="frequencyDesc", handleInvalid="skip").fit(df).transform(df)
    assert rows(got.where("s is not null"), "id", "i") == rows(want, "id", "i")
    assert got.where("s is null").head().i is None and got.count() == df.count()


def test_silhouette_from_sums_equals_the_evaluator(spark):
    rng = np.random.default_rng(6)
    pts = [([float(x) for x in rng.normal(size=3) + 2 * (i % 3)], i % 3) for i in range(90)] + [([9.0, 9.0, 9.0], 3)]
    df = spark.createDataFrame(pts, "x array<double>, c int")
    got = M.silhouette_from_sums(df, "x", "c").head()
    vectors = FE.array_column_to_vector(df, "x", "features").withColumnRenamed("c", "prediction")
    assert got.n == 91 and got.silhouette == pytest.approx(M.silhouette(vectors), abs=1e-9)


def test_bucketed_tables_join_without_an_exchange(spark):
    from tidewater.plans.catalog import queries
    a = R.store_bucketed(spark.range(500).selectExpr("id % 50 as k", "id as a"), ["k"], 4, "test_bucket_a")
    b = R.store_bucketed(spark.range(50).selectExpr("id as k", "id * 2 as b"), ["k"], 4, "test_bucket_b")
    joined = R.inner_join(a, b.hint("merge"), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert joined.count() == 500 and joined.where("b <> k * 2").count() == 0
    plan = queries()["bucketed_join"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_sparse_pivot_holds_the_cells_of_the_dense_one(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "a", 3.0), (1, None, 1.0), (2, "b", None), (None, "a", 1.0)],
                               "u int, i string, v double")
    got = {r.u: [tuple(c) for c in r.cells] for r in sparse_pivot(df, "u", "i", F.sum("v")).collect()}
    assert got == {1: [(None, 1.0), ("a", 5.0)], 2: [("b", None)], None: [("a", 1.0)]}


def test_users_meet_only_items_that_their_cone_lets_through(monkeypatch):
    """Items of one length in all directions: their length alone spares no user any of them."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(6000, 3))
    v /= np.linalg.norm(v, axis=1)[:, None]
    u = np.repeat(np.eye(3), 40, axis=0) + rng.normal(size=(120, 3)) * 0.05
    met, meet = [], RC._Best.meet
    monkeypatch.setattr(RC, "BLOCK", 16)
    monkeypatch.setattr(RC._Best, "meet", lambda self, some, ids, *a: met.append(len(some) * len(ids)) or meet(self, some, ids, *a))
    items, scores = np.full((120, 5), RC.NONE), np.full((120, 5), -np.inf)
    groups = RC._groups(RC._directions(u), np.arange(120), 32)
    for g in groups:
        mine, its = items[g], scores[g]
        RC._search(u[g], mine, its, np.arange(6000), v, np.ones(6000))
        items[g] = mine
    assert sorted(np.concatenate(groups)) == list(range(120)) and max(map(len, groups)) <= 32
    assert items.tolist() == np.lexsort((np.broadcast_to(np.arange(6000), (120, 6000)), -(u @ v.T)), axis=1)[:, :5].tolist()
    assert sum(met) < 120 * 6000 / 4


@pytest.mark.parametrize("case", ["plain", "below zero", "one direction", "one column", "tiny", "equal"])
def test_best_items_of_odd_factors(spark, case):
    rng = np.random.default_rng(9)
    u, v = rng.normal(size=(150, 4)), rng.normal(size=(200, 4)) * rng.exponential(size=(200, 1))
    if case == "below zero":
        u, v = np.abs(u), -np.abs(v)
    elif case == "one direction":
        u = np.outer(np.arange(150) - 20.0, [1.0, 2.0, 0.0, -1.0])     # one user without length, some turned round
    elif case == "one column":
        u, v = u[:, :1], v[:, :1]
    elif case == "tiny":
        u, v = u * 1e-20, v * 1e-12
    elif case == "equal":
        v = np.repeat(v[:10], 20, axis=0)
    frame = lambda m: spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)],
                                            "id bigint, features array<double>")
    exact = np.einsum("ij,kj->ik", u, v)
    for rows_ in (RC.top_items_for_all(frame(u), frame(v), 5, 64).collect(), RC.top_items_of(frame(u), frame(v), 5, 64).collect()):
        got = {(r.id, r["rank"]): r for r in rows_}
        assert len(got) == len(rows_) == 150 * 5
        for i in range(150):
            best = np.sort(exact[i])[::-1][:5]
            mine = [got[i, k + 1] for k in range(5)]
            assert len({r.item for r in mine}) == 5
            assert [r.score for r in mine] == pytest.approx(list(best), rel=1e-9, abs=0)
            assert [exact[i, r.item] for r in mine] == pytest.approx(list(best), rel=1e-9, abs=0)


def test_given_users_search_is_the_models_without_a_cross_join(spark):
    df = spark.range(3000).selectExpr("cast(id % 60 as int) as u", "cast(id * 7 % 41 as int) as i",
                                      "cast((id * id) % 9 as double) as r").groupBy("u", "i").agg(F.max("r").alias("r"))
    model = M.als("u", "i", "r", max_iter=3).fit(df)
    asked = spark.createDataFrame([(0,), (50,), (50,), (999,)], "u int")
    got = M.top_items_for_users(model, asked, "u", "i", 4)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "CartesianProduct" not in plan
    own = model.recommendForUserSubset(asked.distinct(), 4).select("u", F.posexplode("recommendations").alias("p", "b"))
    want = {(r.u, r.p + 1): r.b.rating for r in own.collect()}
    assert {(r.u, r["rank"]): r.score for r in got.collect()} == pytest.approx(want, abs=1e-5) and len(want) == 8
    assert RC.top_items_of(model.userFactors, model.itemFactors.where("false")).count() == 0
    assert RC.top_items_of(model.userFactors.where("false"), model.itemFactors).count() == 0
    few = RC.top_items_of(model.userFactors, model.itemFactors.limit(3), 5).groupBy("id").count().collect()
    assert len(few) == 60 and all(r["count"] == 3 for r in few)
