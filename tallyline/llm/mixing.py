"""Mixing sources to target weights, in DataFrame operations only.

Sizes are summed per source, every source gets a target and with it a
repetition rate, and a document is emitted floor(rate) times plus once more
with the probability of the rate's fraction.  That last draw is a hash of the
seed and the document's id, so reruns agree.

Targets: the sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3
and so on, or as a given table says.  They share ``budget`` times the words of
all documents by weight.  A target stops at ``max_rate`` times its source's
words; what is cut off is shared again by weight until none is above.

Nulls and edges: a null or empty text has size 0 and is taken 0 times as many
words (its row still follows its source's rate); a null source is a source of
its own, the last in order; rows with equal ids draw alike; sources without
words and empty tables have target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import Staging
from .rows import WORD

DRAW_BITS = 52


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _ranked(staging: Staging, sources: DataFrame) -> DataFrame:
    """Adds ``place``, from 1, in the order of the source; no task sorts more than one range."""
    order = F.col("source").asc_nulls_last()
    ranges = staging.keep(
        sources.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return ranges.withColumn("_in", inside).join(offsets, "_range").select(
        *sources.columns, (F.col("_before") + F.col("_in")).alias("place")
    )


def source_targets(
    staging: Staging, sized: DataFrame, budget: float = 1.0, max_rate: int = 3, cycle: int = 3
) -> DataFrame:
    """(source, source_size, target, rate), a row per source, from (source, size) rows."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    table = staging.keep(
        _ranked(staging, sums).select(
            "source", "source_size", ((F.col("place") - 1) % cycle + 1).alias("weight")
        ),
        "targets",
    )
    cap = F.col("source_size") * max_rate

    def level(words: float, weights: int) -> float:
        return words / weights if weights else 0.0

    total, weights = table.agg(F.sum("source_size"), F.sum("weight")).first()
    share = (total or 0) if budget == 1.0 else (total or 0) * budget
    share = min(share, (total or 0) * max_rate)
    at, capped = level(share, weights or 0), -1
    while True:  # each round caps at least one more source; a handful of rounds in practice
        n, cut, freed = table.where(F.col("weight") * F.lit(float(at)) > cap).agg(
            F.count("*"), F.sum(cap), F.sum("weight")
        ).first()
        if n == capped or not n:
            break
        capped = n
        if freed == weights:
            break
        at = level(share - cut, weights - freed)
    wanted = F.col("weight") * F.lit(float(at))
    target = F.when(wanted > cap, cap.cast("double")).otherwise(wanted)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return table.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.least(rate, F.lit(float(max_rate)))
    )


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the seed and the id only."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << DRAW_BITS))


def plan_copies(docs: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to rows with doc_id and source."""
    right = targets.withColumnRenamed("source", "_source")
    whole = F.floor("rate")
    extra = (draw(F.col("doc_id"), seed) < F.col("rate") - whole).cast("long")
    return (
        docs.join(right, docs["source"].eqNullSafe(right["_source"]), "left")
        .withColumn("copies", whole + extra)
        .drop("_source", "rate")
    )


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"))


def mixture_plan(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), a row per document."""
    staging = Staging(docs.sparkSession, "mixing")
    sized = staging.keep(sizes(docs), "sizes")
    return plan_copies(sized, source_targets(staging, sized, **options), seed)


def mix(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, all columns kept."""
    staging = Staging(docs.sparkSession, "mixing")
    sized = staging.keep(sizes(docs), "sizes")
    targets = source_targets(staging, sized, **options).select(
        F.col("source").alias("_source"), F.col("rate").alias("_rate")
    )
    # the table's own names are set aside, so that none of them clashes
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    whole = F.floor("_rate")
    copies = whole + (draw(F.col(at["doc_id"]), seed) < F.col("_rate") - whole).cast("long")
    times = F.when(copies > 0, F.sequence(F.lit(1).cast("long"), copies))
    joined = renamed.join(targets, renamed[at["source"]].eqNullSafe(targets["_source"]), "left")
    return joined.select(*renamed.columns, F.explode(times).alias("_copy")).drop("_copy").toDF(*docs.columns)
