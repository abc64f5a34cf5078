"""The model-building programs end to end, from their CSV files (header line, inferred types).

Rows of these files have no key, so a row's content hash is its key for the
train / holdout split: equal rows fall on the same side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.udfs import EUROPEAN_COUNTRIES, TOP_COUNTRIES
from tidewater.functions.columns import binary_label, category_group
from tidewater.operators import models as M
from tidewater.plans import model_jobs as MJ
from tidewater.sources import text as S

# The header names of the programs' files.
HOUSE_NUMBERS = ("bedrooms", "bathrooms", "sqft_living", "floors", "waterfront")
HOUSE_CATEGORIES = ("condition", "grade", "zipcode")
HOUSE_SHARE = ("sqft_above", "sqft_living", "sqft_above_percentage")
VIEW_NUMBERS = ("firstSub", "age", "all_time_views", "last_month_views")
VIEW_CATEGORIES = ("payment_method_type", "country", "rebill_period_in_months")
VIEW_LABEL, VIEW_FILTER = "next_month_views", "is_cancelled"
TRIAL_NUMBERS = ("rebill_period", "chapter_access_count", "seconds_watched")
GYM_NUMBERS = ("Age", "Height", "Weight", "NoOfReps")
RATING_COLUMNS = ("userId", "courseId", "proportionWatched")


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("row_key", F.xxhash64(*df.columns))


def house_prices_from_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(R² and RMSE of the train and holdout parts, holdout predictions)."""
    return MJ.house_price_model(spark, _keyed(S.read_csv_inferred(spark, path)), "price", HOUSE_NUMBERS,
                                HOUSE_CATEGORIES, "row_key", HOUSE_SHARE)


def retention_from_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(confusion table, summary) of the holdout: will a subscriber watch nothing next month?"""
    df = _keyed(S.read_csv_inferred(spark, path))
    return MJ.retention_model(spark, df, VIEW_LABEL, VIEW_NUMBERS, VIEW_CATEGORIES, "row_key",
                              keep=F.col(VIEW_FILTER), fill_zero=VIEW_NUMBERS)


def views_forecast_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Holdout predictions of next month's views (the label is not among the features)."""
    df = _keyed(S.read_csv_inferred(spark, path)).filter(F.col(VIEW_FILTER))
    return MJ.views_forecast(df, VIEW_LABEL, VIEW_NUMBERS, VIEW_CATEGORIES, "row_key")


def trial_trees_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Holdout accuracy of a tree and a forest: does a free trial end in a payment?"""
    df = _keyed(S.read_csv_inferred(spark, path))
    df = df.withColumn("country", category_group("country", TOP_COUNTRIES, {"EUROPE": EUROPEAN_COUNTRIES}))
    df = df.withColumn("label", binary_label("payments_made", 1, inclusive=True))
    return MJ.trial_conversion_trees(spark, df, "country", TRIAL_NUMBERS, "row_key")


def gym_clusters_from_csv(spark: SparkSession, path: str, k: int = 5) -> DataFrame:
    """Sizes of k clusters of competitors, with the model's cost and silhouette."""
    return MJ.clustering_report(S.read_csv_inferred(spark, path), GYM_NUMBERS, ("Gender",), k)


def repetitions_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ordinary least squares of the repetitions on the competitors' data: intercept, coefficients."""
    numbers = [c for c in GYM_NUMBERS if c != "NoOfReps"]
    return MJ.ols_report(spark, S.read_csv_inferred(spark, path), "NoOfReps", numbers, ("Gender",))


def recommendations_from_csv(spark: SparkSession, path: str, users: Sequence[int], k: int = 5) -> DataFrame:
    """What the given users watched and the k courses recommended to each, as rows."""
    user, item, share = RATING_COLUMNS
    views = S.read_csv_inferred(spark, path).withColumn(share, F.col(share) * 100)
    wanted = spark.createDataFrame([(u,) for u in users], f"{user} bigint")
    ratings = views.withColumn(user, F.col(user).cast("bigint"))
    recs = M.recommend(M.rating_model(ratings, user, item, share), wanted, user, item, k)
    history = ratings.join(wanted.distinct(), user)
    return M.recommendations_with_history(recs, history, user, item, history_score=share)
