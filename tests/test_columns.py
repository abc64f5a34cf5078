from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import columns as C


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_band_score_strict_bounds(spark):
    data = [(0.95,), (0.9,), (0.5000001,), (0.5,), (0.25,), (0.2,), (None,)]
    got = one(spark, C.band_score("r"), data, "r double")
    assert got == [10, 4, 4, 2, 0, 0, 0]


def test_binary_label_null_takes_false_branch(spark):
    data = [(3,), (0,), (None,)]
    assert one(spark, C.binary_label("v", 0, when_true=0, when_false=1), data, "v int") == [0, 1, 1]
    assert one(spark, C.binary_label("v", 1, inclusive=True), [(1,), (0,)], "v int") == [1, 0]


def test_safe_ratio_zero_and_null(spark):
    data = [(10.0, 2), (5.0, 0), (None, 3)]
    assert one(spark, C.safe_ratio("a", "b"), data, "a double, b int") == [5.0, None, None]


def test_month_functions(spark):
    data = [(dt.datetime(2015, 4, 21, 14, 32, 21),), (dt.datetime(2016, 12, 31, 4, 19, 32),)]
    df = spark.createDataFrame(data, "t timestamp")
    got = df.select(C.month_name("t").alias("m"), C.month_number("t").alias("n"),
                    C.month_number_from_name(C.month_name("t")).alias("k")).collect()
    assert [tuple(r) for r in got] == [("April", 4, 4), ("December", 12, 12)]


def test_split_field_and_prefix(spark):
    df = spark.createDataFrame([("Customer#000000007",)], "s string")
    r = df.select(C.split_field("s", "#", 1), C.split_field("s", "#", 2),
                  C.starts_with_any("s", ["X", "Cu"])).first()
    assert tuple(r) == ("Customer", "000000007", True)


def test_pass_rule(spark):
    data = [("A+", "Biology"), ("B", "Biology"), ("B", "Math"), ("C-", "Art"), ("D", "Art")]
    got = one(spark, C.pass_rule("g", "s", "Biology"), data, "g string, s string")
    assert got == [True, False, True, True, False]


def test_category_group(spark):
    data = [("US",), ("DE",), ("GR",), ("EL",), ("UNKNOWN",)]
    from tidewater.functions.udfs import EUROPEAN_COUNTRIES, TOP_COUNTRIES
    expr = C.category_group("c", TOP_COUNTRIES, {"EUROPE": EUROPEAN_COUNTRIES})
    assert one(spark, expr, data, "c string") == ["US", "EUROPE", "OTHER", "EUROPE", "UNKNOWN"]


def test_round_half_up(spark):
    assert one(spark, C.round_half_up("x", 1), [(2.25,), (-2.25,)], "x double") == [2.3, -2.3]


def test_binary_to_string(spark):
    df = spark.createDataFrame([("héllo",)], "s string").select(F.col("s").cast("binary").alias("b"))
    assert df.select(C.binary_to_string("b")).first()[0] == "héllo"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_ntz_instant_round_trip_any_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        wall = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
        df = spark.createDataFrame([(wall,)], "t timestamp_ntz")
        r = df.select(F.unix_micros(C.ntz_to_instant("t")).alias("u"),
                      C.instant_to_ntz(C.ntz_to_instant("t")).alias("back")).first()
        assert r["u"] == 1704067207179575
        assert r["back"] == wall
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_pandas_udfs(spark):
    from tidewater.functions.udfs import brand_number_udf, country_grouping_udf, has_passed_udf
    df = spark.createDataFrame([("Brand#13", "A", "Biology", "GB"), ("Brand#2", "B", "Biology", "GR")],
                               "b string, g string, s string, c string")
    got = df.select(brand_number_udf("b"), has_passed_udf("g", "s"), country_grouping_udf("c")).collect()
    assert [tuple(r) for r in got] == [(13, True, "GB"), (2, False, "OTHER")]
