"""The reference's programs end to end, from their input files.

Each function reads the program's file formats with the schema-first
readers of ``tidewater.sources`` and runs the matching job; results are lazy
DataFrames (show or write them as needed).  Streaming programs return the
streaming DataFrame; start it with ``tidewater.streaming.runner``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.plans import jobs
from tidewater.sources import streams
from tidewater.sources import text as S
from tidewater.streaming import jobs as SJ


def lowest_rated_from_files(spark: SparkSession, ratings_path: str, items_path: str,
                            min_count: int = 10, k: int = 10) -> DataFrame:
    """Whitespace ratings 'user item rating ts' + 'id|name|...' item list."""
    ratings = S.read_whitespace(spark, ratings_path, [(1, "item", "int"), (2, "rating", "double")])
    names = S.read_pipe_lookup(spark, items_path, "item", "name", key_type="int")
    return jobs.lowest_rated_items(ratings, names, min_count=min_count, k=k)


def course_popularity_from_files(spark: SparkSession, views_glob: str, chapters_path: str,
                                 titles_path: str) -> DataFrame:
    """Headerless 'user,chapter[,...]', 'chapter,course' and 'course,title' files."""
    views = S.read_delimited(spark, views_glob, [("user_id", "int"), ("chapter_id", "int")])
    chapters = S.read_delimited(spark, chapters_path, [("chapter_id", "int"), ("course_id", "int")])
    titles = S.read_delimited(spark, titles_path, [("course_id", "int"), ("title", "string")])
    return jobs.course_popularity(views, chapters, titles)


def log_report_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header 'level,datetime' -> rows per level and month, calendar order."""
    return jobs.log_level_by_month(S.read_csv_strings(spark, path))


def exam_report_from_csv(spark: SparkSession, path: str, values: Sequence | None = None) -> DataFrame:
    """CSV with header (subject, year, score, ...) -> subject x year mean / std-dev."""
    results = S.read_csv_strings(spark, path)
    return jobs.exam_stats_pivot(results.withColumn("year", F.col("year").cast("int")),
                                 values=values)


def correlation_report_from_csv(spark: SparkSession, path: str, target: str,
                                drop: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """CSV with header, numeric columns inferred -> correlation of each with target."""
    return jobs.price_correlation_report(S.read_csv_inferred(spark, path), target, drop, digits)


def word_counts_from_files(spark: SparkSession, texts_path: str, stop_words_path: str) -> DataFrame:
    """Every line of the text files -> (word, n) over words not in the stop-word file
    (one word per line), most frequent first (word breaks ties)."""
    from tidewater.operators.text import remove_stop_words, tokenize, word_counts
    texts = spark.read.text(texts_path, wholetext=False)
    stops = spark.read.text(stop_words_path).select(F.lower(F.trim("value")).alias("word")) \
        .filter(F.col("word") != "")
    words = remove_stop_words(tokenize(texts, "value"), "word", stops)
    return word_counts(words, "word", "n").orderBy(F.col("n").desc(), F.col("word").asc())


def viewing_figures_from_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
                               duration: str = "2 minutes", slide: str | None = None,
                               watermark: str | None = None) -> DataFrame:
    """Records whose value is a course name -> seconds watched per course and window
    (streaming DataFrame; needs the Kafka connector on the classpath)."""
    records = streams.kafka_source(spark, bootstrap_servers, topic)
    return SJ.seconds_per_course(records, "timestamp", "value", duration, slide, watermark)


def level_counts_from_socket(spark: SparkSession, host: str = "localhost", port: int = 8989,
                             duration: str = "2 minutes", slide: str = "2 seconds") -> DataFrame:
    """'LEVEL,...' lines from a socket -> count per level over a sliding window of
    arrival (processing) time, as the DStream program counted."""
    lines = streams.socket_source(spark, host, port).withColumn("arrived", F.current_timestamp())
    return SJ.level_counts(lines, "arrived", "value", ",", duration, slide)
