"""Fixtures of the training-data tests: a small table with every awkward row."""
from __future__ import annotations

import random

import pytest

LANES = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("shard", "slot", "size", "key", "kept", "ratio", "p", "h", "n_words", "copies", "root")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def awkward_rows() -> list[tuple]:
    long_text, mid = prose(1, 12000), prose(2, 120)
    near = mid.split()
    near[60] = "changed"
    texts = [(0, ""), (1, None), (2, " \t\r\n"), (3, "a"), (4, "Hello World"), (5, long_text), (5, long_text),
             (6, long_text), (7, mid), (8, mid), (9, " ".join(near)), (None, prose(3, 80)), (None, mid),
             (10, "The The " * 200), (11, "\n".join([prose(4, 12)] * 9)), (12, prose(5, 60) + " ñ é 😀 ﬁn"),
             (13, "x" * 5000), (7, prose(6, 70)), (14, prose(7, 55) + " $$$ " + prose(2, 30)), (-3, mid)]
    return [(i, t, "en" if k % 2 else None, (None, "", "s1", "s2")[k % 4], len(t or ""))
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), LANES)


@pytest.fixture(scope="session")
def crowded(awkward):
    """The same rows with columns named like the operators' own."""
    from pyspark.sql import functions as F
    return awkward.withColumns({c: F.lit(c) for c in CLASH})


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.where("false")


def text_of(row) -> str:
    return row.text or ""
