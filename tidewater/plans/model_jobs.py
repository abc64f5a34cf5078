"""The reference's model-building programs as functions over DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import features as FE
from tidewater.operators import models as M


# The tuning grids (regularisation, elastic net) of the reference's programs.
PRICE_GRID = ((0.01, 0.1, 0.5), (0.0, 0.5, 1.0))
RETENTION_GRID = ((0.01, 0.1, 0.3, 0.5, 0.7, 1.0), (0.0, 0.5, 1.0))


def _encoded_stages(categorical: Sequence[str], numeric: Sequence[str], features: str = "features"):
    idx = [f"{c}_index" for c in categorical]
    vec = [f"{c}_vector" for c in categorical]
    stages = []
    if categorical:
        stages.append(FE.string_indexer(categorical, idx, handle_invalid="keep"))
        stages.append(FE.OneHotEncoder(inputCols=idx, outputCols=vec, handleInvalid="keep"))
    stages.append(FE.assembler(list(numeric) + vec, features))
    return stages


def house_price_model(spark: SparkSession, df: DataFrame, label: str,
                      numeric: Sequence[str], categorical: Sequence[str], keys: Sequence[str] | str,
                      ratio: tuple[str, str, str] | None = None, seed: int = 42,
                      reg_params=PRICE_GRID[0], elastic_nets=PRICE_GRID[1],
                      split=(0.8, 0.2), train_ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Ratio feature, split, indexers -> one-hot -> assembler -> tuned linear
    regression as one fitted stage list; R² and RMSE on train and holdout.

    Returns (report rows (split, r2, rmse, n), holdout predictions).
    """
    fitted, train, holdout = house_price_fit(df, label, numeric, categorical, keys, ratio, seed,
                                             reg_params, elastic_nets, split, train_ratio)
    return price_report(fitted, train, holdout)


def price_report(fitted, train: DataFrame, holdout: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(split, r2, rmse, n) of the two parts, and the holdout predictions."""
    train_m = M.regression_metrics(fitted.transform(train)).select(F.lit("train").alias("split"), "*")
    hold_pred = fitted.transform(holdout)
    hold_m = M.regression_metrics(hold_pred).select(F.lit("holdout").alias("split"), "*")
    return train_m.unionByName(hold_m), hold_pred


def house_price_fit(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str],
                    keys: Sequence[str] | str, ratio: tuple[str, str, str] | None = None, seed: int = 42,
                    reg_params=PRICE_GRID[0], elastic_nets=PRICE_GRID[1], split=(0.8, 0.2),
                    train_ratio: float = 0.8):
    """(fitted stages, training part, holdout) of the house-price job.

    Indexers are fitted on the training split with ``handleInvalid="keep"``,
    so a category seen only in the holdout does not fail the job.
    """
    data = df.withColumnRenamed(label, "label")
    num = list(numeric)
    if ratio is not None:
        a, b, name = ratio
        data = data.withColumn(name, F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")))
        num.append(name)
    train, holdout = FE.seeded_split(data, split, keys, seed)
    lr = M.linear_regression()
    tvs = M.TrainValidationSplit(estimator=lr, estimatorParamMaps=M.grid(lr, reg_params, elastic_nets),
                                 evaluator=RegressionEvaluator(metricName="r2"),
                                 trainRatio=train_ratio, seed=seed, parallelism=4)
    return M.fit_stages(_encoded_stages(categorical, num) + [tvs], train), train, holdout


def retention_model(spark: SparkSession, df: DataFrame, label_source: str,
                    numeric: Sequence[str], categorical: Sequence[str], keys: Sequence[str] | str,
                    keep=None, fill_zero: Sequence[str] = (), seed: int = 42,
                    reg_params=RETENTION_GRID[0], elastic_nets=RETENTION_GRID[1],
                    split=(0.9, 0.1), train_ratio: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Filter, null fill, 0/1 label (1 when ``label_source > 0`` is not true),
    encode, tuned logistic regression.

    Returns (holdout confusion table, holdout summary row).
    """
    model, _, holdout = retention_fit(df, label_source, numeric, categorical, keys, keep, fill_zero, seed,
                                      reg_params, elastic_nets, split, train_ratio)
    pred = model.transform(holdout)
    return M.confusion_table(pred), M.classification_summary(pred)


def retention_fit(df: DataFrame, label_source: str, numeric: Sequence[str], categorical: Sequence[str],
                  keys: Sequence[str] | str, keep=None, fill_zero: Sequence[str] = (), seed: int = 42,
                  reg_params=RETENTION_GRID[0], elastic_nets=RETENTION_GRID[1], split=(0.9, 0.1),
                  train_ratio: float = 0.9):
    """(best model, training part, holdout) of the retention job."""
    data = df if keep is None else df.filter(keep)
    for c in fill_zero:
        data = data.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    data = data.withColumn("label", F.when(F.col(label_source) > 0, 0).otherwise(1).cast("double"))
    stages = _encoded_stages(categorical, numeric)
    keys = [keys] if isinstance(keys, str) else list(keys)
    prepared = M.fit_stages(stages, data).transform(data).select(*keys, "label", "features")
    train, holdout = FE.seeded_split(prepared, split, keys, seed)
    lr = M.logistic_regression()
    tvs_model = M.tune(lr, M.grid(lr, reg_params, elastic_nets),
                       BinaryClassificationEvaluator(metricName="areaUnderROC"), train,
                       train_ratio, seed)
    return tvs_model.bestModel, train, holdout


def trial_conversion_trees(spark: SparkSession, df: DataFrame, country: str,
                           numeric: Sequence[str], keys: Sequence[str] | str,
                           label: str = "label", seed: int = 42,
                           split=(0.8, 0.2)) -> DataFrame:
    """Index the (already grouped) country, assemble, decision tree (depth 3)
    and random forest (depth 6); holdout accuracy of each.

    Rows: (model, accuracy).
    """
    tree, forest, _, holdout = trial_conversion_fit(df, country, numeric, keys, label, seed, split)
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    rows = [("decision_tree", float(ev.evaluate(tree.transform(holdout)))),
            ("random_forest", float(ev.evaluate(forest.transform(holdout))))]
    return spark.createDataFrame(rows, "model string, accuracy double")


def trial_conversion_fit(df: DataFrame, country: str, numeric: Sequence[str], keys: Sequence[str] | str,
                         label: str = "label", seed: int = 42, split=(0.8, 0.2)):
    """(tree, forest, training part, holdout) of the trial-conversion job."""
    indexed, _ = FE.index_strings(df, {country: f"{country}_index"})
    data = FE.assemble(indexed, [f"{country}_index"] + list(numeric), label=label) \
             .select(*([keys] if isinstance(keys, str) else keys),
                     F.col(label).cast("double").alias("label"), "features")
    train, holdout = FE.seeded_split(data, split, keys, seed)
    return M.decision_tree(3, seed).fit(train), M.random_forest(6, seed).fit(train), train, holdout


def views_forecast(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str],
                   keys: Sequence[str] | str, seed: int = 42, split=(0.9, 0.1),
                   train_ratio: float = 0.9) -> DataFrame:
    """Forecast of next month's views: null numbers become 0, categories are
    encoded, a linear regression is tuned over a 6 x 3 grid; holdout predictions.

    Columns: the keys, label, prediction.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    model, _, holdout = views_forecast_fit(df, label, numeric, categorical, keys, seed, split, train_ratio)
    return model.transform(holdout).select(*keys, "label", "prediction")


def views_forecast_fit(df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str],
                       keys: Sequence[str] | str, seed: int = 42, split=(0.9, 0.1), train_ratio: float = 0.9):
    """(fitted stages, training part, holdout) of the forecast."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    data = df.select(*keys, *categorical, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numeric],
                     F.coalesce(F.col(label).cast("double"), F.lit(0.0)).alias("label"))
    train, holdout = FE.seeded_split(data, split, keys, seed)
    lr = M.linear_regression()
    tvs = M.TrainValidationSplit(estimator=lr, estimatorParamMaps=M.grid(lr, *RETENTION_GRID),
                                 evaluator=RegressionEvaluator(metricName="r2"), trainRatio=train_ratio,
                                 seed=seed, parallelism=4)
    return M.fit_stages(_encoded_stages(categorical, numeric) + [tvs], train), train, holdout


def clustering_report(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], k: int = 5,
                      seed: int = 1) -> DataFrame:
    """Encode, assemble, fit k-means: one row per cluster with its size, next to
    the model's cost and silhouette.  Columns: cluster, size, cost, silhouette."""
    return cluster_sizes(*clustering_fit(df, numeric, categorical, k, seed))


def cluster_sizes(model, prepared: DataFrame) -> DataFrame:
    """The report of a fitted clustering: cluster, size, cost, silhouette."""
    pred = model.transform(prepared)
    sizes = pred.groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("size"))
    return sizes.withColumns({"cost": F.lit(float(model.summary.trainingCost)),
                              "silhouette": F.lit(float(M.silhouette(pred)))})


def clustering_fit(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], k: int = 5, seed: int = 1):
    """(model, prepared rows) of the clustering job."""
    prepared = M.fit_stages(_encoded_stages(categorical, numeric), df).transform(df).select("features")
    return M.kmeans(k, seed).fit(prepared), prepared


def ols_report(spark: SparkSession, df: DataFrame, label: str, numeric: Sequence[str],
               categorical: Sequence[str]) -> DataFrame:
    """Index, one-hot, assemble, ordinary least squares: intercept and coefficients.

    Rows: (position, coefficient); position 0 is the intercept.
    """
    data = df.withColumn("label", F.col(label).cast("double"))
    model = M.fit_stages(_encoded_stages(categorical, numeric) + [M.linear_regression()], data).stages[-1]
    rows = [(0, float(model.intercept)), *((i + 1, float(c)) for i, c in enumerate(model.coefficients))]
    return spark.createDataFrame(rows, "position int, coefficient double")
