"""WARC archives with a two-level capture index.

``write_archive`` writes every page as a gzip member of a WARC file: a
``response`` record with its payload, or, if an equal payload of at least
``least_bytes`` belongs to a page with a smaller page_id, a ``revisit`` record
that names it.  ``build_index`` sorts the captures by reversed-host URL key
and writes them as compressed blocks of lines; the end of every index file
holds its sparse directory (first key and place of each block).  ``lookup``
finds keys by binary search: first among the index files' first keys (one per
file), then in a file's directory, then in the one block read.  ``read_records``
reads the records by byte range and checks each payload against its digest.

Files go to the cluster's shared folder through ``pyarrow.fs``.  A task
attempt writes under a name of its own, and only names that a finished stage
returned are used, so attempts that were lost or repeated leave no trace in
the result.  Equal payloads are found by a join on their digest, which Spark
splits where one payload is very common; index files are dealt by range with
the page_id behind the URL key, so a host or URL that holds a third of all
captures spans many files.

Defined results: a null payload is empty; a null URL has the empty key; pages
without page_id are revisits of an equal payload that has one, else responses;
rows that repeat the smallest page_id with its payload are all responses;
an empty table writes nothing and reads nothing; extra columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import stored
from tidewater.session import checkpoint_root

RECORD_ID = "urn:page:"
FILE_BYTES = 256 << 20                      # a WARC file is closed beyond this size
BLOCK_LINES = 3000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, page_id bigint, file string, offset bigint, length bigint"


def reversed_host_key(url: str | None) -> str:
    """``http://Blog.example.com/a?b#c`` -> ``com,example,blog)/a?b``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:                      # not a URL: sorted by its text
        return url.strip()
    if not host:
        return url.strip()
    host = ",".join(reversed(host.split(".")))
    if port and (parts.scheme, port) not in (("http", 80), ("https", 443)):
        host += f":{port}"
    return f"{host}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def capture_key(url: str | None, page_id: int | None) -> str:
    """Index key: URL key, then page_id in an order-keeping form (null last)."""
    own = "~" if page_id is None else f"{page_id + (1 << 63):020d}"
    return reversed_host_key(url).replace("\n", "%0A").replace("\t", "%09") + "\t" + own


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(uri: str):
    """(file system, path) of a folder in the shared store."""
    return pafs.FileSystem.from_uri(uri)


def _record(page_id, url, payload: bytes, refers_to) -> bytes:
    name = "null" if page_id is None else page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    revisit = refers_to is not None
    block = http.encode() + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{RECORD_ID}{name}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append("WARC-Payload-Digest: sha1:" + payload_digest(payload))
    if revisit:
        head += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one uncompressed record: its headers, the HTTP headers and the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[:int(headers["Content-Length"])].partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    return {"headers": headers, "http": fields, "payload": payload}


def with_references(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, payload (binary) and refers_to (null for a response)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
                        F.sha1(payload).alias("digest"))
    first = (slim.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    both = slim.join(first.select("digest", "first"), "digest", "left")
    own = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    return both.select("page_id", "url", "payload", F.when(~own, F.col("first")).alias("refers_to"))


def write_archive(pages: DataFrame, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the WARC files; returns their captures: key, page_id, file, offset, length."""
    folder = f"{checkpoint_root(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex[:12]}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None:
                        fs.create_dir(path, recursive=True)
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    member = gzip.compress(_record(page_id, url, payload, refers), 5, mtime=0)
                    out.write(member)
                    rows.append((capture_key(url, page_id), page_id, f"{folder}/{name}", at, len(member)))
                    at += len(member)
                    if at >= file_bytes:
                        out.close()
                        out = None
                yield _captures(rows)
        finally:
            if out is not None:
                out.close()

    # reading the table back cuts the lineage: the files it names are the ones that count
    return stored(with_references(pages, least_bytes).mapInArrow(run, CAPTURE), "warc-captures")


def _captures(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[], [], [], [], []]
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["key", "page_id", "file", "offset", "length"])


def _tasks(df: DataFrame) -> int:
    """A stated number of tasks: the rows dealt are small, what is read for them is not,
    so adaptive merging of small partitions would go by the wrong size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# ------------------------------------------------------------------ index

def build_index(captures: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the index files; returns one row per file: file, first_key, last_key, n_blocks."""
    folder = f"{checkpoint_root(captures.sparkSession).rstrip('/')}/cdx-{uuid.uuid4().hex[:12]}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        out, at, lines, directory, last = None, 0, [], [], ""
        name = f"{uuid.uuid4().hex}.cdx.gz"

        def flush():
            nonlocal at, lines
            block = gzip.compress("\n".join(lines).encode("utf-8", "surrogatepass"), 6, mtime=0)
            out.write(block)
            directory.append((first_key, at, len(block)))
            at, lines = at + len(block), []

        first_key = ""
        for batch in batches:
            for key, page_id, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                if not lines:
                    first_key = key
                lines.append(json.dumps([key, page_id, file, offset, length]))
                last = key
                if len(lines) >= block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            foot = zlib.compress(json.dumps(directory).encode())
            out.write(foot + len(foot).to_bytes(8, "big"))
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "first_key": directory[0][0],
                                               "last_key": last, "n_blocks": len(directory)}])

    order = ["key", "file", "offset"]
    dealt = captures.select("key", "page_id", "file", "offset", "length").repartitionByRange(
        *order).sortWithinPartitions(*order)
    return stored(dealt.mapInArrow(run, "file string, first_key string, last_key string, n_blocks bigint"),
                  "warc-index")


class IndexFile:
    """One index file: its directory in memory, its blocks read on demand (the last one kept)."""

    def __init__(self, uri: str):
        self.fs, path = _open(uri)
        self.handle = self.fs.open_input_file(path)
        size = self.handle.size()
        n = int.from_bytes(self.handle.read_at(8, size - 8), "big")
        self.directory = json.loads(zlib.decompress(self.handle.read_at(n, size - 8 - n)))
        self.firsts = [d[0] for d in self.directory]
        self.at, self.lines = -1, []

    def block(self, i: int) -> list:
        if i != self.at:
            _, offset, length = self.directory[i]
            text = gzip.decompress(self.handle.read_at(length, offset)).decode("utf-8", "surrogatepass")
            self.at, self.lines = i, [json.loads(line) for line in text.split("\n")]
        return self.lines

    def find(self, low: str, high: str) -> Iterator[list]:
        """Captures with low <= key < high."""
        i = max(0, bisect.bisect_left(self.firsts, low) - 1)
        while i < len(self.firsts) and self.firsts[i] < high:
            lines = self.block(i)
            start = bisect.bisect_left(lines, low, key=lambda x: x[0])
            for line in lines[start:]:
                if line[0] >= high:
                    return
                yield line
            i += 1


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Captures whose key is in column ``key`` of ``keys``: a whole index key, or a URL key for all
    of that URL's captures.  Keys are distinct."""
    files = sorted((r.first_key, r.last_key, r.file) for r in index.collect())   # one row per index file
    shared = index.sparkSession.sparkContext.broadcast(files)

    def span(key: str) -> tuple[str, str]:
        return (key, key + "\x00") if "\t" in key else (key + "\t", key + "\n")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lasts, firsts = [f[1] for f in shared.value], [f[0] for f in shared.value]
        for batch in batches:
            part, key = [], []
            for k in batch.column(0).to_pylist():
                if k is None:
                    continue
                low, high = span(k)
                for i in range(bisect.bisect_left(lasts, low), bisect.bisect_left(firsts, high)):
                    part.append(i)
                    key.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(key, pa.string())],
                                             names=["part", "key"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, file = -1, None
        for batch in batches:
            rows = []
            for part, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != at:
                    at, file = part, IndexFile(shared.value[part][2])
                rows += file.find(*span(key))
            yield _captures(rows)

    routed = keys.select("key").distinct().mapInArrow(route, "part int, key string")
    dealt = routed.repartition(_tasks(index), "part").sortWithinPartitions("part", "key")
    return dealt.mapInArrow(search, CAPTURE)


def read_records(captures: DataFrame) -> DataFrame:
    """The archived pages: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload."""
    def number(uri: str | None):
        tail = (uri or "null").strip("<>").removeprefix(RECORD_ID)
        return None if tail == "null" else int(tail)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, handle = None, None
        for batch in batches:
            rows = []
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if file != at:
                    fs, path = _open(file)
                    at, handle = file, fs.open_input_file(path)
                rec = parse_record(gzip.decompress(handle.read_at(length, offset)))
                head, digest = rec["headers"], rec["headers"]["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = head["WARC-Type"]
                if kind == "response" and payload_digest(rec["payload"]) != digest:
                    raise ValueError(f"payload at {file}:{offset} does not match its digest")
                rows.append((number(head["WARC-Record-ID"]), int(rec["http"]["Content-Length"]), digest, kind,
                             number(head.get("WARC-Refers-To")), head.get("WARC-Target-URI"),
                             rec["payload"] if kind == "response" else None))
            cols = list(zip(*rows)) or [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[
                "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])

    dealt = captures.select("file", "offset", "length").repartition(_tasks(captures), "file")
    dealt = dealt.sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, "
                                 "record_type string, refers_to bigint, url string, payload binary")


def capture_keys(pages: DataFrame) -> DataFrame:
    """The index key of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [capture_key(u, p) for u, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], names=["key"])

    return pages.select("url", F.col("page_id").cast("long")).mapInArrow(run, "key string")


def archived_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes, indexes, looks up and reads back every page."""
    captures = write_archive(pages, least_bytes)
    found = lookup(build_index(captures), capture_keys(pages))
    return read_records(found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
