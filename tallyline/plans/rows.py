"""Rows from computed arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_once(df: DataFrame, array: str, alias: str, *carried: str) -> DataFrame:
    """(carried..., alias): a row per element of an array column without null elements.

    For a plain explode of a column Spark adds checks that the array is not
    empty and moves them below the projection that computes it, so the array
    would be computed again for each check.  The outer form adds none; the
    null row of an empty array is dropped afterwards.
    """
    rows = df.select(*carried, F.explode_outer(array).alias(alias))
    return rows.where(F.col(alias).isNotNull())


def explode_counts(
    df: DataFrame, array: str, value: str, count: str, *carried: str, keep_empty: bool = False
) -> DataFrame:
    """(carried..., value, count): the distinct elements of an array and their number.

    The array is sorted and cut where its element changes, all inside the row:
    nothing is grouped or shuffled.  An empty array gives no row, or with
    ``keep_empty`` one row of nulls.
    """
    ordered = df.select(*carried, F.sort_array(array).alias("_items"))
    size = F.size("_items")
    positions = F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)))
    starts = F.filter(
        positions, lambda i: (i == 0) | (F.get("_items", i) != F.get("_items", i - 1))
    )
    cut = ordered.select(*carried, "_items", F.when(size > 0, starts).alias("_starts"))
    rows = cut.select(*carried, "_items", "_starts", F.posexplode_outer("_starts").alias("_k", "_at"))
    if not keep_empty:
        rows = rows.where(F.col("_at").isNotNull())
    end = F.coalesce(F.get("_starts", F.col("_k") + 1), F.size("_items"))
    return rows.select(
        *carried, F.get("_items", F.col("_at")).alias(value), (end - F.col("_at")).alias(count)
    )
