"""End-to-end jobs (the reference's programs), each one DataFrame plan.

Inputs are DataFrames with the columns named in each signature, so the same
job runs on the driver's tables, on CSV/text sources or on inline rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import DEFAULT_BANDS, band_score, month_name, month_number
from tidewater.operators.pivot import pivot_agg
from tidewater.operators.stats import correlations, numeric_columns


def attach_to_few(few: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left-join a handful of rows (a top-k result) to a possibly huge dimension.

    The few keys are broadcast into a semi-join that filters the dimension
    while it is scanned, so the dimension is never shuffled; the filtered
    dimension is tiny and the final left join keeps every row of ``few``.
    """
    keys = F.broadcast(few.select(key).distinct())
    matched = dim.join(keys, key, "left_semi")
    return few.join(matched, key, "left")


def lowest_rated_items(ratings: DataFrame, names: DataFrame, item: str = "item",
                       rating: str = "rating", min_count: int = 10, k: int = 10) -> DataFrame:
    """Mean rating per item over items with more than ``min_count`` ratings,
    the k lowest (item id breaks ties), with the item's name.

    Columns: item, name, n_ratings, avg_rating.
    """
    stats = ratings.groupBy(item).agg(F.count(F.lit(1)).alias("n_ratings"),
                                      F.avg(F.col(rating).cast("double")).alias("avg_rating"))
    worst = (stats.filter(F.col("n_ratings") > min_count)
             .orderBy(F.col("avg_rating").asc(), F.col(item).asc()).limit(k))
    named = attach_to_few(worst, names.select(item, "name"), item)
    # k rows: re-sorting after the name join is free and keeps the report ordered
    return (named.select(item, "name", "n_ratings", "avg_rating")
            .orderBy(F.col("avg_rating").asc(), F.col(item).asc()))


def course_popularity(views: DataFrame, chapters: DataFrame, titles: DataFrame,
                      user: str = "user_id", chapter: str = "chapter_id", course: str = "course_id",
                      title: str = "title", bands=DEFAULT_BANDS) -> DataFrame:
    """Score courses by the share of their chapters each user watched.

    distinct (user, chapter) -> chapter's course (inner) -> chapters watched per
    (user, course) / chapters in the course -> band score -> sum per course ->
    title (inner) -> descending score.  Columns: course, title, score.
    """
    chapters = chapters.select(chapter, course)
    chapter_counts = chapters.groupBy(course).agg(F.count(F.lit(1)).alias("n_chapters"))
    seen = views.select(user, chapter).distinct()
    watched = (seen.join(chapters, chapter, "inner")
               .groupBy(user, course).agg(F.count(F.lit(1)).alias("n_watched")))
    # Users per (course, chapters watched): at most one row per chapter of a
    # course, pre-counted map-side.  Only these meet the chapter counts, so a
    # course watched by a third of all users moves a few rows, not its users.
    levels = watched.groupBy(course, "n_watched").agg(F.count(F.lit(1)).alias("n_users"))
    scored = (levels.join(chapter_counts, course, "inner")
              .select(course, (band_score(F.col("n_watched") / F.col("n_chapters"), bands).cast("long")
                               * F.col("n_users")).alias("score")))
    per_course = scored.groupBy(course).agg(F.sum("score").alias("score"))
    out = per_course.join(titles.select(course, title), course, "inner")
    return out.select(course, title, "score").orderBy(F.col("score").desc(), F.col(course).asc())


def log_level_by_month(logs: DataFrame, level: str = "level", when: str = "datetime") -> DataFrame:
    """Rows per (level, month name) in calendar order.  Columns: level, month, total."""
    ts = F.col(when)
    if not isinstance(logs.schema[when].dataType, (T.TimestampType, T.TimestampNTZType)):
        ts = ts.cast("timestamp")
    counted = (logs.select(F.col(level).alias("level"), month_name(ts).alias("month"),
                           month_number(ts).alias("month_num"))
               .groupBy("level", "month", "month_num").agg(F.count(F.lit(1)).alias("total")))
    return counted.orderBy("month_num").drop("month_num")


def exam_stats_pivot(results: DataFrame, subject: str = "subject", year: str = "year",
                     score: str = "score", values: Sequence | None = None,
                     digits: int = 2) -> DataFrame:
    """subject x year: mean and sample std-dev of the score, rounded.

    Cells are named ``<year>_avg`` and ``<year>_std_dev``.
    """
    s = F.col(score).cast("double")
    return pivot_agg(results, subject, year,
                     {"avg": (lambda c: F.round(F.avg(c), digits), s),
                      "std_dev": (lambda c: F.round(F.stddev_samp(c), digits), s)},
                     values)


def price_correlation_report(df: DataFrame, target: str, drop: Sequence[str] = (),
                             digits: int | None = None) -> DataFrame:
    """Drop the listed columns, correlate every remaining numeric column with target."""
    kept = df.drop(*drop)
    return correlations(kept, target, numeric_columns(kept, exclude=[target]), digits)
