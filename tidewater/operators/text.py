"""Word tokens and stop-word removal over whole texts.

Tokenising is ``explode(split(lower(text), pattern))``: one JVM generator,
no Python.  The stop list is either a literal list (an ``InSet`` predicate,
no join at all) or a DataFrame (a left-anti join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The default stop-word list (common English function words).
STOP_WORDS: tuple[str, ...] = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "has", "have",
    "he", "her", "his", "i", "in", "is", "it", "its", "not", "of", "on", "or", "she",
    "so", "that", "the", "their", "there", "they", "this", "to", "was", "we", "were",
    "will", "with", "you",
)

# Anything but letters and their combining marks separates words, in any script.
WORD_PATTERN = r"[^\p{L}\p{M}]+"


def tokenize(df: DataFrame, text_col: str, pattern: str = WORD_PATTERN, lower: bool = True,
             keep: Sequence[str] = (), word_col: str = "word") -> DataFrame:
    """One row per non-empty token of the whole text, extra columns in ``keep``.

    On a small input the number of tasks follows ``spark.sql.files.maxPartitionBytes``.
    """
    t = F.lower(F.col(text_col)) if lower else F.col(text_col)
    words = df.select(*keep, F.explode(F.split(t, pattern)).alias(word_col))
    return words.filter(F.col(word_col) != "")


def remove_stop_words(words: DataFrame, word_col: str,
                      stop_words: Sequence[str] | DataFrame = STOP_WORDS) -> DataFrame:
    """Keep the words that are not in the stop list."""
    if isinstance(stop_words, DataFrame):
        stops = stop_words.select(F.col(stop_words.columns[0]).alias(word_col)).distinct()
        return words.join(stops, word_col, "left_anti")
    return words.filter(~F.col(word_col).isin(list(stop_words)))


def word_counts(words: DataFrame, word_col: str = "word", name: str = "n") -> DataFrame:
    """Occurrences per word; partial counts are combined map-side, so a very
    frequent word costs one row per task in the shuffle."""
    return words.groupBy(word_col).agg(F.count(F.lit(1)).alias(name))
