"""The file-level programs on small generated files."""
from __future__ import annotations

from conftest import rows
from tidewater.plans import programs as P
from tidewater.session import scratch_path


def _text(spark, lines, name, crlf=False):
    path = scratch_path(spark, name)
    end = "\r" if crlf else ""
    spark.createDataFrame([(x + end,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_course_popularity_from_crlf_files(spark):
    views = _text(spark, ["14,96,2020-01-01", "14,97,x", "13,96,x", "13,96,x", "14,99,x", "13,100,x"],
                  "views")
    chapters = _text(spark, ["96,1", "97,1", "98,1", "99,2"] + [f"{c},3" for c in range(100, 110)],
                     "chapters", crlf=True)
    titles = _text(spark, ["1,first", "2,second ", "3,third"], "titles", crlf=True)
    out = P.course_popularity_from_files(spark, views + "/*.txt", chapters, titles).collect()
    assert [(r["course_id"], r["title"], r["score"]) for r in out] == [
        (2, "second ", 10), (1, "first", 6), (3, "third", 0)]


def test_lowest_rated_from_files(spark):
    ratings = _text(spark, [f"{u}\t{i}\t{r}\t881250949" for u in range(12)
                            for i, r in ((1, 4), (2, 1), (3, 2))], "ratings")
    items = _text(spark, ["1|Alpha (1995)|x", "2|Beta|y", "3|Gamma|z"], "items")
    out = P.lowest_rated_from_files(spark, ratings, items, k=2).collect()
    assert [(r["item"], r["name"], r["avg_rating"]) for r in out] == [(2, "Beta", 1.0), (3, "Gamma", 2.0)]


def test_log_and_exam_reports_from_csv(spark):
    logs = _text(spark, ["level,datetime", "WARN,2016-12-31 04:19:32", "INFO,2015-4-21 14:32:21"], "logs")
    assert rows(P.log_report_from_csv(spark, logs)) == [("INFO", "April", 1), ("WARN", "December", 1)]
    exams = _text(spark, ["subject,year,score,grade", "Math,2005,80,B", "Math,2005,90,A",
                          "Art,2006,60,C"], "exams")
    out = P.exam_report_from_csv(spark, exams)
    assert out.columns == ["subject", "2005_avg", "2005_std_dev", "2006_avg", "2006_std_dev"]
    got = {r["subject"]: r for r in out.collect()}
    assert got["Math"]["2005_avg"] == 85.0 and got["Art"]["2006_avg"] == 60.0


def test_correlation_report_from_csv(spark):
    path = _text(spark, ["id,price,size,rooms", "1,100,10,1", "2,200,20,3", "3,300,31,2"], "houses")
    got = dict(rows(P.correlation_report_from_csv(spark, path, "price", drop=["id"], digits=3)))
    assert set(got) == {"size", "rooms"} and got["size"] > 0.99


def test_kafka_program_explains_missing_connector(spark):
    import pytest
    with pytest.raises(RuntimeError, match="Kafka"):
        P.viewing_figures_from_kafka(spark, "localhost:9092", "viewrecords")


def test_word_counts_from_files(spark):
    texts = _text(spark, ["The cat and the dog.", "A dog, a DOG!", ""], "texts")
    stops = _text(spark, ["the", "A ", "and", ""], "stops", crlf=True)
    out = [(r["word"], r["n"]) for r in P.word_counts_from_files(spark, texts, stops).collect()]
    assert out == [("dog", 3), ("cat", 1)]
