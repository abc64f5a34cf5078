"""ML invariants: disjoint split, metric identities, SSE identity, seeds,
label leakage refused, unseen categories, null features."""
from __future__ import annotations

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tidewater.operators import features as FE
from tidewater.operators import models as M
from tidewater.sources.tables import Tables


def test_split_is_disjoint_and_complete(spark, small_dir):
    o = Tables(spark, small_dir).orders.select("o_orderkey")
    r = FE.split_check(FE.seeded_split(o, [0.8, 0.2], "o_orderkey", 7), "o_orderkey").first()
    assert r["total"] == o.count() and r["overlap"] == 0


def test_persisted_training_side_over_a_shuffle_join_stays_disjoint(spark, small_dir):
    """Reading one side from a cache and the other afresh, with other partitions, moves no row."""
    t = Tables(spark, small_dir)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size")
        df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(part, "l_partkey")
        train, holdout = FE.seeded_split(df, [0.8, 0.2], ["l_orderkey", "l_linenumber"])
        train = train.persist()
        n = train.count()
        both = train.withColumn("part", F.lit(0)).unionByName(holdout.withColumn("part", F.lit(1)))
        keys = both.groupBy("l_orderkey", "l_linenumber").agg(F.count_distinct("part").alias("parts"))
        assert keys.where("parts > 1").count() == 0 and both.count() == df.count()
        assert 0.7 < n / df.count() < 0.9
        train.unpersist()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_split_by_any_key_type_and_nulls(spark):
    df = spark.createDataFrame([(f"k{i}" if i % 7 else None, i - 500) for i in range(1000)], "s string, i int")
    for keys in ("s", "i", ["s", "i"]):
        parts = FE.seeded_split(df, [0.5, 0.3, 0.2], keys, 3)
        sizes = [p.count() for p in parts]
        assert sum(sizes) == 1000 and all(p.columns == df.columns for p in parts)
        if keys != "s":
            assert abs(sizes[0] - 500) < 80 and abs(sizes[2] - 200) < 60


def test_dense_ids(spark):
    df = spark.createDataFrame([(2**40,), (-3,), (7,), (7,), (None,)], "k bigint")
    assert sorted(map(tuple, FE.dense_ids(df, "k", "no").collect())) == [(-3, 0), (7, 1), (2**40, 2)]


def test_regression_metrics_match_evaluator(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.5), (4.0, 3.0), (10.0, 8.0)],
                               "label double, prediction double")
    r = M.regression_metrics(df).first()
    assert r["r2"] == pytest.approx(RegressionEvaluator(metricName="r2").evaluate(df), rel=1e-12)
    assert r["rmse"] == pytest.approx(RegressionEvaluator(metricName="rmse").evaluate(df), rel=1e-12)


def test_accuracy_and_recall_identity(spark):
    data = [(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0), (0.0, 0.0)]
    df = spark.createDataFrame(data, "label double, prediction double")
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert M.accuracy(df).first()[0] == pytest.approx(acc)
    s = M.classification_summary(df).first()
    assert s["accuracy"] == pytest.approx(acc)
    assert s["tpr_1"] + s["fpr_0"] == pytest.approx(1.0)           # "positive accuracy" = recall
    assert s["tpr_1"] == pytest.approx(2 / 3) and s["fpr_1"] == pytest.approx(1 / 4)
    assert sorted(tuple(r) for r in M.confusion_table(df).collect()) == [
        (0.0, 0.0, 3), (0.0, 1.0, 1), (1.0, 0.0, 1), (1.0, 1.0, 2)]


def test_label_among_features_is_refused():
    with pytest.raises(ValueError):
        FE.assembler(["age", "label"], "features")


def test_null_feature_raises_by_default(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    with pytest.raises(Exception):
        FE.assemble(df, ["a", "b"]).collect()
    assert FE.assemble(df, ["a", "b"], handle_invalid="skip").count() == 1


def test_string_index_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("M",)] * 10 + [("F",)] * 10 + [("X",)] * 3, "g string")
    out, model = FE.index_strings(df, {"g": "gi"})
    assert list(model.labelsArray[0]) == ["F", "M", "X"]
    back = FE.index_to_string(out.select("gi").distinct(), "gi", "g2")
    assert sorted((r["gi"], r["g2"]) for r in back.collect()) == [(0.0, "F"), (1.0, "M"), (2.0, "X")]


def test_unseen_category_kept(spark):
    train = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    hold = spark.createDataFrame([("a",), ("zzz",)], "c string")
    m = FE.string_indexer(["c"], ["ci"], handle_invalid="keep").fit(train)
    assert sorted(r["ci"] for r in m.transform(hold).collect()) == [0.0, 2.0]


def test_one_hot_drops_last(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "i double")
    out = FE.vector_elements(FE.one_hot(df, ["i"], ["v"]), "v", 2, "e", keep=["i"])
    assert sorted(tuple(r) for r in out.collect()) == [(0.0, 1.0, 0.0), (1.0, 0.0, 1.0), (2.0, 0.0, 0.0)]


def test_linear_regression_matches_closed_form(spark):
    df = spark.createDataFrame([(1.0, 3.1), (2.0, 4.9), (3.0, 7.2), (4.0, 8.8)], "x double, label double")
    model = M.linear_regression().fit(FE.assemble(df, ["x"]))
    assert model.coefficients[0] == pytest.approx(1.94, abs=1e-9)
    assert model.intercept == pytest.approx(1.15, abs=1e-9)


def test_kmeans_sse_identity_and_seed(spark, small_dir):
    e = FE.array_column_to_vector(Tables(spark, small_dir).embeddings, "embedding")
    m1 = M.kmeans(5, seed=3).fit(e)
    pred = m1.transform(e)
    sse = M.sse_from_centers(spark, pred, m1).first()["sse"]
    assert sse == pytest.approx(m1.summary.trainingCost, rel=1e-9)
    m2 = M.kmeans(5, seed=3).fit(e)
    assert [list(c) for c in m1.clusterCenters()] == [list(c) for c in m2.clusterCenters()]
    assert -1.0 <= M.silhouette(pred) <= 1.0


def test_forest_fixed_seed_is_reproducible(spark):
    rows = [(float(i % 2), float(i), float(i % 7)) for i in range(60)]
    df = FE.assemble(spark.createDataFrame(rows, "label double, a double, b double"), ["a", "b"])
    p1 = M.random_forest(4, seed=5).fit(df).transform(df).select("prediction").collect()
    p2 = M.random_forest(4, seed=5).fit(df).transform(df).select("prediction").collect()
    assert p1 == p2


def test_als_recommendations_and_history(spark):
    ratings = [(u, i, float((u * i) % 5 + 1)) for u in range(6) for i in range(8) if (u + i) % 3]
    big = 2**40                                   # keys beyond an int
    df = spark.createDataFrame([(u + big, i + big, r) for u, i, r in ratings], "user_id bigint, item_id bigint, rating double")
    fitted = M.rating_model(df, "user_id", "item_id", "rating", max_iter=5)
    wanted = spark.createDataFrame([(big,), (big + 3,), (999,), (big,)], "user_id bigint")
    recs = M.recommend(fitted, wanted, "user_id", "item_id", 3)
    assert sorted((r.user_id - big, r["rank"]) for r in recs.collect()) == [(u, k) for u in (0, 3) for k in (1, 2, 3)]
    assert all(0 <= r.item_id - big < 8 for r in recs.collect())
    both = M.recommendations_with_history(recs, df, "user_id", "item_id")
    kinds = {r["kind"]: r["count"] for r in both.groupBy("kind").count().collect()}
    assert kinds == {"recommended": 6, "watched": len(ratings)}


def test_forecast_clustering_and_ols_jobs(spark):
    from tidewater.plans import model_jobs as MJ
    data = [(i, "ab"[i % 2], float(i % 10) if i % 9 else None, 3.0 + 2.0 * (i % 10) + (5.0 if i % 2 else 0.0))
            for i in range(300)]
    df = spark.createDataFrame(data, "k int, c string, x double, y double")
    pred = MJ.views_forecast(df, "y", ["x"], ["c"], "k").collect()
    assert pred and all(abs(r.label - r.prediction) < 12 for r in pred)
    report = MJ.clustering_report(df.fillna(0.0), ["x"], ["c"], k=3).collect()
    assert sum(r["size"] for r in report) == 300 and len({r.cost for r in report}) == 1
    clean = df.where("x is not null")
    ols = {r.position: r.coefficient for r in MJ.ols_report(spark, clean, "y", ["x"], ["c"]).collect()}
    assert len(ols) >= 3 and ols[1] == pytest.approx(2.0, abs=1e-6)


def test_grid_report_marks_one_choice(spark):
    rows = [(float(i), float(2 * i + (i % 3))) for i in range(40)]
    df = FE.assemble(spark.createDataFrame(rows, "x double, label double"), ["x"])
    lr = M.linear_regression()
    tvs = M.tune(lr, M.grid(lr, (0.0, 1.0), (0.0, 1.0)), RegressionEvaluator(metricName="r2"),
                 df, 0.8, seed=1)
    rep = M.grid_report(spark, tvs, "r2").collect()
    assert len(rep) == 4 and sum(r["chosen"] for r in rep) == 1
