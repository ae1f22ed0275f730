"""Spreading hot join keys over several partitions, exactly.

A key is hot when it holds more than 1/fan of all rows.  There can be fewer
than ``fan`` such keys, whatever the data, so the table of hot keys has a
proven size bound and may be broadcast.  Rows of a hot key are spread over
numbered slots; the matching row on the other side is copied once per slot,
at most 2 * fan copies in all.  ``fan`` follows the number of shuffle
partitions, so that no slot outweighs an even partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_FAN = 256


def hot_keys(
    counts: DataFrame, keys: Sequence[str], n: str = "n", fan: int | None = None
) -> DataFrame:
    """Hot keys of a per-key count table, with the number of slots for each."""
    if fan is None:
        partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        fan = max(MIN_FAN, partitions)
    total = counts.agg(F.sum(n)).scalar()
    share = F.col(n) * F.lit(float(fan)) / total
    return counts.where(share > 1.0).select(*keys, F.ceil(share).cast("int").alias("slots"))


def salt_many(
    df: DataFrame, hot: DataFrame, keys: Sequence[str], spread_by: Sequence[Column | str]
) -> DataFrame:
    """The large side: adds ``slot``, a stable function of ``spread_by``."""
    slot = F.pmod(F.xxhash64(*spread_by), F.col("slots"))
    return (
        df.join(F.broadcast(hot), list(keys), "left")
        .withColumn("slot", F.coalesce(slot, F.lit(0)).cast("int"))
        .drop("slots")
    )


def salt_one(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The side with one row per key: one copy for every slot of that key."""
    last = F.coalesce(F.col("slots"), F.lit(1)) - 1
    return (
        df.join(F.broadcast(hot), list(keys), "left")
        .withColumn("slot", F.explode(F.sequence(F.lit(0), last)))
        .drop("slots")
    )


def salted_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[Column | str],
    counts: DataFrame,
    how: str = "inner",
) -> DataFrame:
    """Equi-join that keeps any hot key of ``many`` under 1/fan of the rows per task."""
    hot = hot_keys(counts, keys)
    left = salt_many(many, hot, keys, spread_by)
    right = salt_one(one, hot, keys)
    return left.join(right, [*keys, "slot"], how).drop("slot")
