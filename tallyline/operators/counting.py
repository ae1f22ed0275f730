"""Word, prefix and line counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_distinct_tokens, prefix, tokens
from ..plans.rows import explode_once


def word_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """(w, n): occurrences of every token."""
    words = docs.select(F.explode(tokens(text)).alias("w"))
    return words.groupBy("w").agg(F.count("*").alias("n"))


def prefix_count(docs: DataFrame, k: int = 2, text: str = "text") -> DataFrame:
    """(prefix, n): occurrences of the first ``k`` characters, tokens of length >= k."""
    words = docs.select(F.explode(tokens(text)).alias("w")).where(F.length("w") >= k)
    return words.groupBy(prefix("w", k).alias("prefix")).agg(F.count("*").alias("n"))


def lookup(counts: DataFrame, key: str, value: str) -> DataFrame:
    """The row of one key in a count table."""
    return counts.where(F.col(key) == value)


def top_counts(counts: DataFrame, key: str, k: int = 3, n: str = "n") -> DataFrame:
    """The ``k`` most frequent keys, ties by key."""
    return counts.orderBy(F.desc(n), F.asc(key)).limit(k)


def line_words(
    lines: DataFrame, *carried: str, max_tokens: int | None = None, text: str = "text"
) -> DataFrame:
    """(carried..., w): the token set of every line, a row per word.

    The array is a projected column before it is exploded, so that Spark
    evaluates the shared parts of its expression once per line.
    """
    sets = lines.select(*carried, first_distinct_tokens(text, max_tokens).alias("ws"))
    return explode_once(sets, "ws", "w", *carried)


def line_df(lines: DataFrame, max_tokens: int | None = None, text: str = "text") -> DataFrame:
    """(w, n): number of lines whose token set holds w; with ``max_tokens``, the set of the first ones."""
    words = line_words(lines, max_tokens=max_tokens, text=text)
    return words.groupBy("w").agg(F.count("*").alias("n"))


def line_count(lines: DataFrame) -> DataFrame:
    """(n): all lines, empty ones included."""
    return lines.agg(F.count("*").alias("n"))


def map_sum(stripes: DataFrame, key: str, stripe: str = "stripe") -> DataFrame:
    """(key, neighbour, total): element-wise sum of the maps of each key.

    The result stays flat: rows per (key, neighbour) combine before the
    shuffle, and no merged map has to fit into one row.
    """
    flat = stripes.select(key, F.explode(stripe).alias("neighbour", "value"))
    return flat.groupBy(key, "neighbour").agg(F.sum("value").alias("total"))
