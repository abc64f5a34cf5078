"""Models, tuning and evaluation on Spark ML.

Estimators are Spark ML's distributed implementations.  Evaluation metrics
are also offered as DataFrame aggregates (``regression_metrics``,
``classification_summary``, ``confusion_table``, ``accuracy``): one lazy
aggregation over the predictions, comparable to a SQL oracle, instead of
several evaluator jobs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplitModel
from pyspark.ml.tuning import TrainValidationSplit as _TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import recommend as RC
from tidewater.operators import tuning as TU
from tidewater.operators.features import dense_ids
from tidewater.session import free_shuffles, written


# ---------------------------------------------------------------- metrics

def regression_metrics(pred: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """One row (r2, rmse, n), as ``RegressionEvaluator`` defines them."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    agg = pred.agg(F.sum(err * err).alias("sse"), F.count(F.lit(1)).alias("n"),
                   F.var_samp(F.col(label).cast("double")).alias("var"))
    return agg.select((F.lit(1.0) - F.col("sse") / (F.col("var") * (F.col("n") - 1))).alias("r2"),
                      F.sqrt(F.col("sse") / F.col("n")).alias("rmse"), "n")


def confusion_table(pred: DataFrame, label: str = "label",
                    prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return pred.agg(F.avg(hit).alias("accuracy"))


def classification_summary(pred: DataFrame, label: str = "label",
                           prediction: str = "prediction") -> DataFrame:
    """Binary (0/1) labels: accuracy and the per-label true/false positive rates.

    ``tpr_k`` = share of label-k rows predicted k; ``fpr_k`` = share of the
    other label's rows predicted k.  For two classes ``fpr_0 = 1 - tpr_1``.
    """
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")

    def share(num, den):
        return F.sum(F.when(num & den, 1.0).otherwise(0.0)) / F.sum(F.when(den, 1.0).otherwise(0.0))

    return pred.agg(
        F.avg((y == p).cast("double")).alias("accuracy"),
        share(p == 0.0, y == 0.0).alias("tpr_0"), share(p == 1.0, y == 1.0).alias("tpr_1"),
        share(p == 0.0, y != 0.0).alias("fpr_0"), share(p == 1.0, y != 1.0).alias("fpr_1"))


# ---------------------------------------------------------------- fitting

def linear_regression(features: str = "features", label: str = "label", solver: str = "normal",
                      reg_param: float = 0.0, elastic_net: float = 0.0) -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=label, solver=solver,
                            regParam=reg_param, elasticNetParam=elastic_net)


def logistic_regression(features: str = "features", label: str = "label") -> LogisticRegression:
    return LogisticRegression(featuresCol=features, labelCol=label)


def decision_tree(max_depth: int = 3, seed: int = 42, features: str = "features",
                  label: str = "label") -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=max_depth, seed=seed, featuresCol=features,
                                  labelCol=label)


def random_forest(max_depth: int = 6, seed: int = 42, num_trees: int = 20,
                  features: str = "features", label: str = "label") -> RandomForestClassifier:
    return RandomForestClassifier(maxDepth=max_depth, seed=seed, numTrees=num_trees,
                                  featuresCol=features, labelCol=label)


def grid(estimator, reg_params: Sequence[float], elastic_nets: Sequence[float]):
    return (ParamGridBuilder().addGrid(estimator.regParam, list(reg_params))
            .addGrid(estimator.elasticNetParam, list(elastic_nets)).build())


class TrainValidationSplit(_TrainValidationSplit):
    """Spark ML's, with one pass per part for a grid of linear regressions.

    The fit and the R² of every grid point follow from the moments of the two
    parts (``tuning.py``), so the rows are not read again for each point; the
    best point is refitted on all rows by the estimator.  Label and features
    are stored once.  Other estimators, metrics and parameters go the plain way.
    """

    def _shared(self) -> bool:
        est, ev = self.getEstimator(), self.getEvaluator()
        return (type(est) is LinearRegression and type(ev) is RegressionEvaluator and ev.getMetricName() == "r2"
                and est.getFitIntercept() and est.getStandardization() and est.getLoss() == "squaredError"
                and not est.isDefined("weightCol") and not ev.isDefined("weightCol") and not ev.getThroughOrigin()
                and ev.getLabelCol() == est.getLabelCol() and ev.getPredictionCol() == est.getPredictionCol()
                and not self.getCollectSubModels()
                and all({p.name for p in point} <= {"regParam", "elasticNetParam"} for point in self.getEstimatorParamMaps()))

    def _fit(self, dataset: DataFrame):
        if not self._shared():
            return super()._fit(dataset)
        est, points = self.getEstimator(), self.getEstimatorParamMaps()
        x, y = est.getFeaturesCol(), est.getLabelCol()
        slim = written(dataset.select(F.col(y).cast("double").alias(y), x,
                                      F.rand(self.getSeed()).alias("_part")), "tuning-rows")
        parts = slim.where(F.col("_part") < self.getTrainRatio()), slim.where(F.col("_part") >= self.getTrainRatio())
        train, held = (TU.vector_moments(p, x, y) for p in parts)
        if train is None or held is None:
            return super()._fit(slim.drop("_part"))
        metrics = []
        for point in points:
            at = est.copy(point)
            metrics.append(TU.r2(held, *TU.elastic_net(train, at.getRegParam(), at.getElasticNetParam(),
                                                         population=est.getSolver() != "l-bfgs")))
        best = max(range(len(points)), key=lambda i: metrics[i])
        return self._copyValues(TrainValidationSplitModel(est.fit(slim.drop("_part"), points[best]), metrics, []))


def tune(estimator, param_maps, evaluator, train: DataFrame, train_ratio: float = 0.8,
         seed: int = 42, parallelism: int = 4):
    """TrainValidationSplit; best model refit on all of ``train``."""
    tvs = TrainValidationSplit(estimator=estimator, estimatorParamMaps=param_maps,
                               evaluator=evaluator, trainRatio=train_ratio, seed=seed,
                               parallelism=parallelism)
    return tvs.fit(train)          # caches its two parts itself


def grid_report(spark: SparkSession, tvs_model, metric_name: str) -> DataFrame:
    """One row per grid point: reg_param, elastic_net, metric, chosen."""
    larger_better = tvs_model.getEvaluator().isLargerBetter()
    metrics = list(tvs_model.validationMetrics)
    best = (max if larger_better else min)(range(len(metrics)), key=lambda i: metrics[i])
    rows = []
    for i, (pm, m) in enumerate(zip(tvs_model.getEstimatorParamMaps(), metrics)):
        params = {p.name: v for p, v in pm.items()}
        rows.append((float(params.get("regParam", 0.0)), float(params.get("elasticNetParam", 0.0)),
                     float(m), i == best))
    schema = T.StructType([T.StructField("reg_param", T.DoubleType()),
                           T.StructField("elastic_net", T.DoubleType()),
                           T.StructField(metric_name, T.DoubleType()),
                           T.StructField("chosen", T.BooleanType())])
    return spark.createDataFrame(rows, schema)


def fit_stages(stages: Sequence, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(train)


# ---------------------------------------------------------------- what a right fit must satisfy

def optimality_gap(model, data: DataFrame, features: str = "features", label: str = "label") -> float:
    """How far a fitted linear or binary logistic regression is from the optimum of its own
    elastic-net objective on the rows it was fitted on; 0 at the optimum.

    The largest breach of the optimality conditions, in units of standardised
    features (and label, for a linear model): the residuals' mean is 0, and each
    feature's mean product with them equals its penalty's slope (or stays within
    the L1 weight where the coefficient is 0).  One pass, one row of sums;
    constant features carry no condition.
    """
    scored = model.transform(data)
    logistic = "probability" in scored.columns
    fitted = vector_to_array("probability").getItem(1) if logistic else F.col("prediction")
    rows = scored.select(F.col(label).cast("double").alias("y"), (F.col(label) - fitted).alias("r"),
                         F.col(features).alias("x"))
    # sums of r * x as two sums with positive weights: sparse rows cost their own entries only
    x, up, down = F.col("x"), F.greatest("r", F.lit(0.0)) + 1, F.greatest(-F.col("r"), F.lit(0.0)) + 1
    n, sy, off, own, more, less, wide, narrow = rows.agg(
        F.count(F.lit(1)), F.stddev_samp("y"), F.avg("r"), Summarizer.metrics("mean", "variance").summary(x),
        Summarizer.mean(x, up), Summarizer.mean(x, down), F.sum(up), F.sum(down)).head()
    if not n or not sy:
        return 0.0
    spreads = own.variance.toArray() ** 0.5
    products = (more.toArray() * wide - less.toArray() * narrow) / n - own.mean.toArray() * off
    unit = 1.0 if logistic else sy
    penalty, mix = model.getOrDefault("regParam") / unit, model.getOrDefault("elasticNetParam")
    worst = abs(off) / unit
    for j, (sx, c) in enumerate(zip(map(float, spreads), map(float, products))):
        if not sx > 1e-12:
            continue
        w = float(model.coefficients[j]) * sx / unit
        slope = c / (sx * unit) - penalty * (1 - mix) * w
        l1 = penalty * mix
        worst = max(worst, abs(slope - l1 * (1 if w > 0 else -1)) if w else max(0.0, abs(slope) - l1))
    return worst


def brier_score(pred: DataFrame, label: str = "label") -> float:
    """Mean squared gap between a binary classifier's probability of 1 and the label."""
    gap = vector_to_array("probability").getItem(1) - F.col(label)
    return pred.agg(F.avg(gap * gap)).head()[0]


def one_cut_brier(data: DataFrame, feature: str, label: str = "label") -> float:
    """The same of the simplest tree: one cut at the feature's mean, each side's share as its probability."""
    mean = data.agg(F.avg(feature)).head()[0]
    sides = data.groupBy(F.col(feature) > F.lit(mean)).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("p"))
    return sides.agg(F.sum(F.col("n") * F.col("p") * (1 - F.col("p"))) / F.sum("n")).head()[0]


def center_distances(pred: DataFrame, model, features: str = "features") -> DataFrame:
    """``distances``: each row's squared distance to each of the k centres."""
    x = vector_to_array(F.col(features))

    def to(center):
        return F.aggregate(F.zip_with(x, F.lit([float(v) for v in center]), lambda a, b: (a - b) * (a - b)),
                           F.lit(0.0), lambda s, v: s + v)

    return pred.withColumn("distances", F.array(*[to(c) for c in model.clusterCenters()]))


def total_squares(data: DataFrame, features: str = "features") -> float:
    """Sum of squared distances to the mean of all rows."""
    v, n = data.agg(Summarizer.variance(F.col(features)), F.count(F.lit(1))).head()
    return float(v.toArray().sum()) * (n - 1) if n > 1 else 0.0


# ---------------------------------------------------------------- clustering

def kmeans(k: int = 5, seed: int = 1, features: str = "features", max_iter: int = 20) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol=features, maxIter=max_iter)


def silhouette(pred: DataFrame, features: str = "features", prediction: str = "prediction") -> float:
    return ClusteringEvaluator(featuresCol=features, predictionCol=prediction).evaluate(pred)


def centers_frame(spark: SparkSession, model) -> DataFrame:
    """k rows (cluster, center array) from the fitted model (k x dim values)."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def sse_from_centers(spark: SparkSession, pred: DataFrame, model, features: str = "features",
                     prediction: str = "prediction") -> DataFrame:
    """Sum of squared distances to the assigned centre, recomputed by a join
    with the k-row centre table (k rows: broadcast is bounded by k)."""
    centers = centers_frame(spark, model).withColumnRenamed("cluster", prediction)
    pts = pred.select(prediction, vector_to_array(F.col(features)).alias("_x"))
    j = pts.join(F.broadcast(centers), prediction)
    sq = F.aggregate(F.zip_with("_x", "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                     lambda acc, v: acc + v)
    return j.agg(F.sum(sq).alias("sse"))


# ---------------------------------------------------------------- recommendation

def als(user: str, item: str, rating: str, max_iter: int = 10, reg_param: float = 0.1,
        rank: int = 10, seed: int = 42) -> ALS:
    """Explicit-rating ALS; cold-start rows are dropped from predictions.

    Every 5 iterations the factor RDDs are checkpointed to the SparkContext
    checkpoint folder (set it to the shared ``spark.checkpoint.dir``, see
    ``tidewater.session.checkpoint_root``), so a lost executor does not
    replay the whole iteration history.
    """
    return ALS(userCol=user, itemCol=item, ratingCol=rating, maxIter=max_iter, regParam=reg_param,
               rank=rank, seed=seed, coldStartStrategy="drop", checkpointInterval=5)


def top_items_for_users(model, users: DataFrame, user: str, item: str, k: int = 5) -> DataFrame:
    """(user, rank, item, score): the k best items of the *given* users only.

    The users are the query set; the factors of those that the model knows meet
    all item factors in blocks, where the items lie, without a row per pair.
    """
    asked = model.userFactors.join(users.select(F.col(user).alias("id")).distinct(), "id")
    return RC.top_items_of(asked, model.itemFactors, k).select(
        F.col("id").cast("int").alias(user), "rank", F.col("item").cast("int").alias(item), "score")


#: Ratings in a block of ALS, about.  A task builds one block, or solves one with the factors that its
#: ratings ask for: some 70 bytes a rating, whatever the table's size.
BLOCK_RATINGS = 1 << 21
#: Bytes of a split of the stored ratings (one to two million of them) that a fit in many blocks reads.
SPLIT_BYTES = 16 << 20


class Factors(NamedTuple):
    """The factors of a fitted rating model, stored: (id, features) of users and of items."""
    userFactors: DataFrame
    itemFactors: DataFrame


class RatingModel(NamedTuple):
    """``users`` and ``items`` map keys to dense ints; ``numbered`` holds the ratings by those."""
    model: Factors
    users: DataFrame
    items: DataFrame
    numbered: DataFrame


def fit_factors(ratings: DataFrame, user: str, item: str, rating: str, **params) -> Factors:
    """ALS with as many blocks as the ratings need, its factors stored; ``ratings`` are stored rows.

    A fixed number of blocks would put ever more ratings in one task.  With more than the usual ten,
    the factors are checkpointed in each iteration, which removes the shuffles of the one before, and
    files are read in small splits, as a reading task holds rows of every pair of blocks.
    """
    spark = ratings.sparkSession
    learner = als(user, item, rating, **params)
    blocks = -(-ratings.count() // BLOCK_RATINGS)
    splits = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(splits)
    if blocks > learner.getNumUserBlocks():
        learner.setNumBlocks(blocks).setCheckpointInterval(1)
        spark.conf.set(splits, str(SPLIT_BYTES))
    try:
        fitted = learner.fit(ratings)
    finally:
        spark.conf.set(splits, usual)
    return Factors(written(fitted.userFactors, "user-factors"), written(fitted.itemFactors, "item-factors"))


def rating_model(ratings: DataFrame, user: str, item: str, rating: str, **params) -> RatingModel:
    """ALS over any key type: the factors, user ids, item ids, numbered ratings."""
    users, items = dense_ids(ratings, user, "user_no"), dense_ids(ratings, item, "item_no")
    numbered = written(ratings.join(users, user).join(items, item).select(
        "user_no", "item_no", F.col(rating).cast("float").alias(rating)), "numbered-ratings")
    free_shuffles(ratings.sparkSession)
    model = fit_factors(numbered, "user_no", "item_no", rating, **params)
    free_shuffles(ratings.sparkSession)        # the fit's own: nothing refers to it any more
    return RatingModel(model, users, items, numbered)


def score_gap(model, recs: DataFrame, user: str = "user_no", item: str = "item_no") -> float:
    """Largest gap between a recommended score and the product of the two factors."""
    u = model.userFactors.select(F.col("id").alias(user), F.col("features").alias("u"))
    i = model.itemFactors.select(F.col("id").alias(item), F.col("features").alias("i"))
    dot = F.aggregate(F.zip_with("u", "i", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0),
                      lambda s, v: s + v)
    return recs.join(u, user).join(i, item).agg(F.max(F.abs(F.col("score") - dot))).head()[0] or 0.0


#: Ratings in a tile of ``rating_errors``, about.
TILE_RATINGS = 1 << 21


def rating_errors(fitted: RatingModel, rating: str) -> tuple[float, float]:
    """(RMSE of the model on the ratings, RMSE of their mean).

    Users and items are dealt to P parts each by number; a task takes the ratings of one user part and
    one item part and the factors of both.  Factors travel P times, not once for each rating.
    """
    model, ratings = fitted.model, fitted.numbered
    n, spread = ratings.agg(F.count(F.lit(1)), F.stddev_pop(rating)).head()
    parts = max(1, math.isqrt(max(0, n - 1) // TILE_RATINGS) + 1)

    def part(c: str):
        return F.pmod(F.col(c), F.lit(parts))

    def factors(side: DataFrame, is_user: bool) -> DataFrame:
        own, other = part("id"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        dealt = side.select("id", "features", own.alias("own"), other.alias("other"))
        tile = F.col("own") * parts + F.col("other") if is_user else F.col("other") * parts + F.col("own")
        return dealt.select(tile.alias("tile"), F.lit(is_user).alias("is_user"), "id", "features")

    def errors(rows: pa.Table, both: pa.Table) -> pa.Table:
        def rows_of(is_user: bool) -> np.ndarray:
            t = both.filter(pc.equal(both.column("is_user"), is_user))
            at = t.column("id").to_numpy() // parts
            flat = pc.list_flatten(t.column("features")).to_numpy()
            out = np.full((at.max(initial=-1) + 1, len(flat) // max(1, len(at))), np.nan, dtype=np.float32)
            out[at] = flat.reshape(len(at), -1)
            return out

        u, v = rows_of(True), rows_of(False)
        sse = 0.0
        for b in rows.to_batches(max_chunksize=1 << 16):
            x, y = (f[b.column(c).to_numpy() // parts] for f, c in ((u, "user_no"), (v, "item_no")))
            e = b.column("rating").to_numpy().astype(np.float64) - np.einsum("ij,ij->i", x, y, dtype=np.float64)
            sse += float(e @ e)
        return pa.table({"sse": [sse]}) if rows.num_rows else pa.table({"sse": pa.array([], pa.float64())})

    tiles = ratings.select((part("user_no") * parts + part("item_no")).alias("tile"), "user_no", "item_no",
                           F.col(rating).alias("rating")).groupBy("tile")
    both = factors(model.userFactors, True).unionByName(factors(model.itemFactors, False)).groupBy("tile")
    sse = tiles.cogroup(both).applyInArrow(errors, "sse double").agg(F.sum("sse")).head()[0]
    return math.sqrt(sse / n) if n else 0.0, spread or 0.0


def recommend(fitted: RatingModel, wanted: DataFrame | None, user: str, item: str, k: int = 5) -> DataFrame:
    """(user, rank, item, score) in the original keys for the users in ``wanted``, or for every user if it is None."""
    model, users, items, _ = fitted
    if wanted is None:
        recs = RC.top_items_for_all(model.userFactors, model.itemFactors, k).select(
            F.col("id").cast("int").alias("user_no"), "rank", F.col("item").cast("int").alias("item_no"), "score")
    else:
        users = users.join(wanted.select(user).distinct(), user)
        recs = top_items_for_users(model, users, "user_no", "item_no", k)
    return recs.join(users, "user_no").join(items, "item_no").select(user, "rank", item, "score")


def recommendations_with_history(recs: DataFrame, history: DataFrame, user: str, item: str,
                                 score: str = "score", history_score: str = "rating") -> DataFrame:
    """Recommendations next to what each user already rated, as rows tagged
    'recommended' / 'watched' (one union: no per-user job, no collected lists)."""
    r = recs.select(user, F.lit("recommended").alias("kind"), item,
                    F.col(score).cast("double").alias("score"))
    h = history.select(user, F.lit("watched").alias("kind"), item,
                       F.col(history_score).cast("double").alias("score"))
    return r.unionByName(h)


def silhouette_from_sums(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """(silhouette, n) of a given assignment, squared Euclidean distance, from per-cluster sums.

    A point's mean distance to a cluster follows from the cluster's row count,
    vector sum and sum of squared lengths; those are k x d numbers, so points
    never meet points.  ``features`` is an array column; a point alone in its
    cluster counts 0.
    """
    x = df.select(F.col(cluster).alias("c"), F.col(features).cast("array<double>").alias("x"))
    x = x.withColumn("xx", F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    sums = x.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("xx").alias("q"))
    each = x.select("c", F.posexplode("x")).groupBy("c", "pos").agg(F.sum("col").alias("s"))
    vectors = each.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))),
                                                lambda p: p["s"]).alias("y"))
    clusters = sums.join(vectors, "c").agg(F.collect_list(F.struct("c", "n", "q", "y")).alias("all"))
    # the one row of k clusters goes to every point
    pairs = x.withColumn("_one", F.lit(1)).join(F.broadcast(clusters.withColumn("_one", F.lit(1))), "_one")

    def mean(e):
        dot = F.aggregate(F.zip_with(F.col("x"), e["y"], lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        whole = e["n"] * F.col("xx") + e["q"] - 2 * dot
        return whole / F.when(e["c"] == F.col("c"), F.greatest(e["n"] - 1, F.lit(1))).otherwise(e["n"])

    own = F.filter("all", lambda e: e["c"] == F.col("c"))[0]
    other = F.array_min(F.transform(F.filter("all", lambda e: e["c"] != F.col("c")), mean))
    points = pairs.select(own["n"].alias("n"), mean(own).alias("a"), other.alias("b"))
    value = F.when(F.col("n") == 1, 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return points.agg(F.avg(value).alias("silhouette"), F.count(F.lit(1)).alias("n"))
