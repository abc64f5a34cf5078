"""WARC archives and their index: exact round trip, revisits, lookups."""
from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidewater.llm import warc as W
from tidewater.llm.common import read

PAGES = [(1, "http://b.example.com/x", "hello"), (2, "http://a.example.com/", "hello"), (3, None, None),
         (4, "http://a.example.com/", ""), (5, "not a url", "é😀\r\n\r\nWARC/1.1"), (6, "https://a.example.com:444/q?x=1#f", "z" * 70000),
         (6, "https://a.example.com:444/q?x=1#f", "z" * 70000), (None, "http://c/", "hello"), (None, "http://c/", "alone"),
         (7, "http://a.example.com/", "more"), (-2, "http://[bad", "hello")]


def expected(rows, least=0):
    first = {}
    for p, _, html in rows:
        b = (html or "").encode()
        if p is not None and len(b) >= least:
            first[b] = min(first.get(b, p), p)
    out = []
    for p, _, html in rows:
        b = (html or "").encode()
        same = first.get(b) if len(b) >= least else None
        refers = None if same is None or same == p else same
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("file", F.lit("f"))


@pytest.mark.parametrize("least", [0, 5, 100])
def test_round_trip(pages, least):
    assert sorted(map(tuple, W.archived_pages(pages, least).collect()), key=str) == expected(PAGES, least)


def test_table_round_trip(spark, small_dir):
    table = read(spark, small_dir, "pages")
    rows = [tuple(r) for r in table.select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, W.archived_pages(table).collect()), key=str) == expected(rows)


def test_small_blocks_and_files(pages, spark):
    captures = W.write_archive(pages, file_bytes=500)
    assert captures.select("file").distinct().count() > 1
    index = W.build_index(captures, block_lines=2)
    assert index.agg(F.sum("n_blocks")).head()[0] >= 5
    keys = spark.createDataFrame([("com,example,a)/",), ("com,example,b)/x",), ("com,none)/",), (None,)], "key string")
    got = sorted((r.key.split("\t")[0], r.page_id) for r in W.lookup(index, keys).collect())
    assert got == [("com,example,a)/", 2), ("com,example,a)/", 4), ("com,example,a)/", 7), ("com,example,b)/x", 1)]
    whole = W.read_records(W.lookup(index, W.capture_keys(pages)))
    bodies = {(r.page_id, bytes(r.payload)) for r in whole.where("record_type = 'response'").collect()}
    assert (5, "é😀\r\n\r\nWARC/1.1".encode()) in bodies and (6, b"z" * 70000) in bodies


def test_a_damaged_payload_is_found(pages, spark, tmp_path):
    raw = gzip.compress(W._record(1, "http://x/", b"abc", None).replace(b"abc", b"abd"))
    (tmp_path / "x.warc.gz").write_bytes(raw)
    bad = spark.createDataFrame([(str(tmp_path / "x.warc.gz"), 0, len(raw))], "file string, offset bigint, length bigint")
    with pytest.raises(Exception, match="does not match its digest"):
        W.read_records(bad).collect()


def test_keys():
    assert W.reversed_host_key("http://Blog.example.com/a?b#c") == "com,example,blog)/a?b"
    assert W.reversed_host_key("https://x.org:443") == "org,x)/"
    assert W.reversed_host_key("https://x.org:8443/") == "org,x:8443)/"
    assert W.reversed_host_key(None) == W.reversed_host_key("") == ""
    assert sorted([W.capture_key("http://a/", i) for i in (-5, 0, 7, None)]) == [
        W.capture_key("http://a/", i) for i in (-5, 0, 7, None)]


def test_empty(pages):
    assert W.archived_pages(pages.where("false")).count() == 0
