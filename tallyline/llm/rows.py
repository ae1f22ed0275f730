"""Small helpers for rows of ``documents``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The blanks between words, and a word, as Java and RE2 patterns.
WORD = r"[^\x20\x09-\x0D]+"


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, text) with null texts empty.

    ``version`` tells rows apart that share an id but not a text; identical
    rows are one document that is repeated.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text")
    )


def null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality on the named columns in which null equals null."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def join_null_safe(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps the left side's key columns only."""
    renamed = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
    on = reduce(lambda a, b: a & b, [left[n].eqNullSafe(renamed[f"_r_{n}"]) for n in names])
    return left.join(renamed, on, how).drop(*[f"_r_{n}" for n in names])


def free_name(columns: Sequence[str], name: str) -> str:
    """A column name that is not taken, whatever the case of its letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
