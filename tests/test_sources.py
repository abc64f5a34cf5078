from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.session import scratch_path
from tidewater.sources import text as S


def _lines(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_read_delimited_ignores_surplus_fields(spark):
    p = _lines(spark, ["1,10,2020-01-01 10:00", "2,20,2020-01-02 11:00,extra"], "delim")
    df = S.read_delimited(spark, p, [("user", "int"), ("chapter", "int")])
    assert rows(df) == [(1, 10), (2, 20)]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "int"]


def test_read_delimited_bad_number_raises(spark):
    p = _lines(spark, ["1,10", "x,20"], "delim-bad")
    with pytest.raises(Exception):
        S.read_delimited(spark, p, [("user", "int"), ("chapter", "int")]).collect()


def test_read_delimited_missing_field_raises(spark):
    p = _lines(spark, ["1,10", "2"], "delim-short")
    with pytest.raises(Exception):
        S.read_delimited(spark, p, [("user", "int"), ("chapter", "int")]).collect()


def test_read_whitespace(spark):
    p = _lines(spark, ["196\t242\t3\t881250949", "  186  302 3.5   891717742 ", ""], "ws")
    df = S.read_whitespace(spark, p, [(1, "item", "int"), (2, "rating", "double")])
    assert rows(df) == [(242, 3.0), (302, 3.5)]


def test_read_pipe_lookup_no_quoting(spark):
    p = _lines(spark, ['1|Toy Story (1995)|01-Jan-1995', '2|"Quoted" Title|x'], "pipe")
    assert rows(S.read_pipe_lookup(spark, p, key_type="int")) == [(1, "Toy Story (1995)"),
                                                                  (2, '"Quoted" Title')]


def test_csv_strings_and_inferred_and_glob(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", 3.0)], "id int, name string, x double")
    p = scratch_path(spark, "csv")
    S.write_csv(df.repartition(2), p)
    strings = S.read_csv_strings(spark, p)
    assert all(f.dataType.simpleString() == "string" for f in strings.schema.fields)
    inferred = S.read_csv_inferred(spark, p)
    assert [f.dataType.simpleString() for f in inferred.schema.fields] == ["int", "string", "double"]
    typed = S.read_csv_typed(spark, f"{p}/part-*.csv", "id int, name string, x double")
    assert rows(typed) == [(1, "a", 2.5), (2, "b", 3.0)]


def test_inline_rows_schema(spark):
    df = S.inline_rows(spark, [("WARN", "2016-12-31 04:19:32")], "level string, datetime string")
    assert df.columns == ["level", "datetime"] and df.count() == 1


def test_write_lines_round_trip(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    p = S.write_lines(df, scratch_path(spark, "lines"), "|")
    assert rows(spark.read.text(p)) == [("1|x",), ("2|y",)]


def test_scratch_paths_are_under_checkpoint_root(spark):
    from tidewater.session import checkpoint_root
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b and a.startswith(checkpoint_root(spark).rstrip("/"))


class _FakeContext:
    def __init__(self, master, conf=None, ckpt=None):
        self.master = master
        self._conf = conf or {}
        self._ckpt = ckpt
        self.set_to = None

    def getConf(self):
        conf = self._conf

        class _C:
            def get(self, key, default=None):
                return conf.get(key, default)
        return _C()

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self.set_to = d


class _FakeSession:
    def __init__(self, sc):
        self.sparkContext = sc


def test_checkpoint_root_on_a_cluster_needs_the_shared_folder():
    from tidewater.session import checkpoint_root
    with pytest.raises(RuntimeError):
        checkpoint_root(_FakeSession(_FakeContext("yarn")))
    sc = _FakeContext("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert checkpoint_root(_FakeSession(sc)) == "hdfs://nn/shared/ckpt"
    assert sc.set_to == "hdfs://nn/shared/ckpt"
    sc2 = _FakeContext("k8s://x", ckpt="s3a://bucket/ckpt/1234-uuid")
    assert checkpoint_root(_FakeSession(sc2)) == "s3a://bucket/ckpt"


def test_scale_settings_grow_with_the_data():
    from tidewater.session import scale_settings
    tb = 1 << 40
    big = scale_settings(100 * tb, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 200 * 1024     # 50 TB / 256 MB
    small = scale_settings(1 << 30, total_cores=64)
    assert int(small["spark.sql.shuffle.partitions"]) == 192         # 3 waves of 64 cores
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_text_round_trip_with_nulls_and_empty_strings(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "b", None)], "a int, b string, c string")
    path = scratch_path(spark, "lines")
    S.write_lines(df, path, "|")
    got = S.read_delimited(spark, path, [("a", "int"), ("b", "string"), ("c", "string")], "|")
    assert rows(got) == [(1, "", "x"), (2, "", "y"), (3, "b", "")]
    with pytest.raises(Exception, match="missing field d"):
        S.read_delimited(spark, path, [("a", "int"), ("b", "string"), ("c", "string"), ("d", "int")], "|").collect()
    loose = S.read_delimited(spark, path, [("a", "int"), ("b", "string"), ("c", "string"), ("d", "int")], "|", strict=False)
    assert [r.d for r in loose.collect()] == [None] * 3
