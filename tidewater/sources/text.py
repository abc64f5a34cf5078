"""Delimited text and CSV readers (and the writers the round-trip tests use).

Schema-first: every reader takes the column names and types, so no extra
inference pass runs over the data; ``read_csv_inferred`` exists for callers
that want Spark's inference (optionally on a sample of the input).  Number
parsing uses ANSI casts, so a malformed number raises instead of turning
into null; surplus fields at the end of a line are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Field = tuple[str, str]   # (name, Spark SQL type)


def read_csv_strings(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header line; every column a string (no inference pass)."""
    return spark.read.option("header", True).option("sep", sep).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str,
                   header: bool = True, sep: str = ",", mode: str = "FAILFAST") -> DataFrame:
    """CSV with an explicit schema; a path may be a glob of part files."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("mode", mode).csv(path))


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",",
                      sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with header and inferred types (one extra pass over the sample)."""
    return (spark.read.option("header", True).option("inferSchema", True).option("sep", sep)
            .option("samplingRatio", sampling_ratio).csv(path))


def _typed(cols: Sequence[Field], strict: bool):
    out = []
    for name, typ in cols:
        c = F.col(name)
        if strict:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"missing field {name}"))).otherwise(c)
        out.append(c.cast(typ).alias(name) if typ != "string" else c.alias(name))
    return out


def read_delimited(spark: SparkSession, path: str, fields: Sequence[Field], sep: str = ",",
                   strict: bool = True) -> DataFrame:
    """Headerless lines split on ``sep``; the first ``len(fields)`` fields typed.

    Lines are split literally (no quoting), so an empty field is an empty
    string; in a typed column it is null.  Typed fields are cast with ANSI
    semantics: ``"x"`` where an int belongs raises.  ``strict`` also raises on
    a line with too few fields; otherwise they are null.
    """
    parts = F.split(F.col("value"), re.escape(sep))
    lines = spark.read.text(path).filter(F.col("value") != "").select(parts.alias("p"))
    out = []
    for i, (name, typ) in enumerate(fields):
        c = F.get("p", F.lit(i))
        if strict:
            c = F.when(F.size("p") > i, c).otherwise(F.raise_error(F.lit(f"missing field {name}")).cast("string"))
        out.append((c if typ == "string" else F.nullif(c, F.lit("")).cast(typ)).alias(name))
    return lines.select(*out)


def read_whitespace(spark: SparkSession, path: str, fields: Sequence[tuple[int, str, str]],
                    strict: bool = True) -> DataFrame:
    """Whitespace-separated lines; keep the listed (0-based position, name, type)."""
    parts = F.split(F.trim(F.col("value")), r"\s+")
    lines = spark.read.text(path).filter(F.trim(F.col("value")) != "")
    raw = lines.select(*[parts.getItem(i).alias(n) for i, n, _ in fields])
    return raw.select(*_typed([(n, t) for _, n, t in fields], strict))


def read_pipe_lookup(spark: SparkSession, path: str, key: str = "item", name: str = "name",
                     key_type: str = "bigint") -> DataFrame:
    """'id|name|...' lines -> (id, name): a dimension for broadcast lookups."""
    return read_delimited(spark, path, [(key, key_type), (name, "string")], sep="|")


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table from in-memory rows with an explicit schema (no inference)."""
    return spark.createDataFrame(list(rows), schema)


def write_lines(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> str:
    """Write each row as one text line, fields joined by ``sep`` (no quoting).

    A null is written like an empty string; text lines cannot tell them apart.
    """
    # concat_ws skips nulls, which would shift the fields after them
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.mode(mode).text(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path
