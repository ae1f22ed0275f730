"""Orders and running sums too long for one window partition.

Rows are dealt into ranges of the order by Spark's range partitioner, which
samples them; the number of the range is the number of the partition.  A
window inside each range and a window over the ranges' totals add up to the
running sum, so no task sorts more than one range or more than the list of
ranges.  A group with nearly all rows lies in many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import Staging


def _ranges(df: DataFrame, blocks: int | None) -> int:
    return blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_before(
    df: DataFrame,
    values: Sequence[str],
    block: str,
    order: str,
    group: Sequence[str] = (),
) -> DataFrame:
    """Adds ``<value>_before``: the sum over all earlier rows of the group.

    ``order`` must be unique inside (group, block), and blocks must be ordered
    like ``order``.
    """
    group = list(group)
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*group, block).orderBy(order).rowsBetween(*earlier)
    across = Window.partitionBy(*group).orderBy(block).rowsBetween(*earlier)
    totals = df.groupBy(*group, block).agg(*[F.sum(v).alias(v) for v in values])
    offsets = totals.select(
        *group, block, *[F.coalesce(F.sum(v).over(across), F.lit(0)).alias(f"_o_{v}") for v in values]
    )
    local = df.select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_i_{v}") for v in values]
    )
    summed = local.join(offsets, [*group, block])
    for v in values:
        summed = summed.withColumn(f"{v}_before", F.col(f"_i_{v}") + F.col(f"_o_{v}"))
    return summed.drop(*[f"_i_{v}" for v in values], *[f"_o_{v}" for v in values])


def with_score_block(rows: DataFrame, score: str, by: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """Adds ``block``: the number of the range of (by, score) that holds the row.

    Equal keys are in one range, ranges rise with the score inside each group,
    and there are as many as shuffle partitions unless told otherwise.  The
    rows are stored, so that their numbers stay.
    """
    placed = rows.repartitionByRange(_ranges(rows, blocks), *by, score).withColumn("block", F.spark_partition_id())
    return Staging(rows.sparkSession, "ranges").keep(placed, "ranges")


def with_positions(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = (), name: str = "position") -> DataFrame:
    """Adds the row's place in the order of its group, from 0 on without gaps.

    Rows are sorted inside ranges only and numbered there; the sizes of the
    group's earlier ranges are added.  Rows that tie in ``order`` are numbered
    one after the other.  Nulls come first.  The result is read from storage.
    """
    by, order = list(by), [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [f"_order{i}" for i in range(len(order))]
    keyed = df.withColumns(dict(zip(keys, order)))
    in_order = keyed.repartitionByRange(_ranges(df, None), *by, *keys).sortWithinPartitions(*by, *keys).drop(*keys)
    staging = Staging(df.sparkSession, "positions")
    # the number of the partition in the upper bits, of the row inside it in the lower ones
    placed = staging.keep(in_order.withColumn("_row", F.monotonically_increasing_id()).withColumn("_range", F.spark_partition_id()))
    runs = placed.groupBy("_range", *by).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each range of each group, however many rows it has
    offsets = runs.select("_range", *by, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    renamed = offsets.withColumnsRenamed({c: f"_r_{c}" for c in ["_range", *by]})
    on = placed["_range"] == renamed["_r__range"]
    for c in by:
        on = on & placed[c].eqNullSafe(renamed[f"_r_{c}"])
    return placed.join(renamed, on).withColumn(name, F.col("_row") + F.col("_shift")).select(*df.columns, name)


def first_of_each(df: DataFrame, order: Sequence[str], n: int, by: Sequence[str]) -> DataFrame:
    """The rows of each group up to its ``n``-th in the order; ties with that one stay too.

    Only the order's columns are ranked.  Every group's ``n``-th key is its
    threshold, a row a group, and the rows themselves are filtered by it.
    """
    by, order = list(by), list(order)
    ranked = with_positions(df.select(*by, *order), order, by, "_nth")
    last = ranked.where(F.col("_nth") == n - 1).select(
        *[F.col(c).alias(f"_r_{c}") for c in by], F.struct(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)]).alias("_last")
    )
    on = F.lit(True)
    for c in by:
        on = on & df[c].eqNullSafe(last[f"_r_{c}"])
    key = F.struct(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)])
    return df.join(last, on, "left").where(F.col("_last").isNull() | (key <= F.col("_last"))).select(*df.columns)
