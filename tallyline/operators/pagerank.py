"""Personalized PageRank with one or many sources.

A graph is nodes(id) and edges(src, dst); repeated edges are separate shares.
Ranks are (source, id, p) and hold only p > 0; every other node has 0.

One iteration is linear in the ranks.  With restart probability alpha, node u
sends (1 - alpha) / outdegree along each edge to an existing node, and all
the rest of its probability back to the source: alpha, the whole share of a
dangling node, and shares addressed to absent nodes.  Because the ranks of a
source sum to 1, this equals jumping with alpha and handing the missing mass
to the source, without a separate pass to measure that mass.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.durable import checkpointed, checkpointed_by
from ..plans.skew import hot_keys, salt_many, salt_one
from ..plans.staging import Staging

ALPHA = 0.15
CHECKPOINT_EVERY = 5


class Transitions(NamedTuple):
    """Weighted steps, laid out by (src, slot), and the hot source nodes."""

    steps: DataFrame
    hot: DataFrame


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(num_nodes, num_edges, num_active_nodes); active nodes have out-edges."""
    out = edges.groupBy("src").agg(F.count("*").alias("n"))
    totals = out.agg(F.sum("n").alias("e"), F.count("*").alias("a"))
    return nodes.agg(F.count("*").alias("num_nodes")).select(
        "num_nodes",
        F.coalesce(totals.select("e").scalar(), F.lit(0)).alias("num_edges"),
        totals.select("a").scalar().alias("num_active_nodes"),
    )


def validate_graph(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(dup_nodes, missing_structure): repeated node ids, absent targets."""
    dup = nodes.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    absent = edges.select(F.col("dst").alias("id")).distinct().join(nodes, "id", "left_anti")
    return dup.agg(F.count("*").alias("dup_nodes")).select(
        "dup_nodes", absent.agg(F.count("*")).scalar().alias("missing_structure")
    )


def init_ranks(nodes: DataFrame, sources: Sequence[int]) -> DataFrame:
    """(source, id, p): probability 1 at each source that is a node."""
    here = nodes.where(F.col("id").isin(list(sources)))
    return here.select(F.col("id").alias("source"), "id", F.lit(1.0).alias("p"))


def _unique(nodes: DataFrame) -> DataFrame:
    """The node ids; a node listed twice fails the job that reads them."""
    message = F.concat(F.lit("node listed twice: "), F.col("id").cast("string"))
    checked = F.when(F.col("n") > 1, F.raise_error(message).cast("bigint")).otherwise(F.col("id"))
    return nodes.groupBy("id").agg(F.count("*").alias("n")).select(checked.alias("id"))


def _multiplicities(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(src, dst, m, known): parallel edges merged; known if dst is a node."""
    merged = edges.groupBy("src", "dst").agg(F.count("*").alias("m"))
    present = nodes.select(F.col("id").alias("dst"), F.lit(True).alias("known"))
    return merged.join(present, "dst", "left").withColumn("known", F.col("known").isNotNull())


def _out_stats(flagged: DataFrame) -> DataFrame:
    """(src, outdegree, kept, n): edges out, those to nodes, distinct targets."""
    return flagged.groupBy("src").agg(
        F.sum("m").alias("outdegree"),
        F.sum(F.when(F.col("known"), F.col("m")).otherwise(0)).alias("kept"),
        F.count("*").alias("n"),
    )


def transitions(nodes: DataFrame, edges: DataFrame, alpha: float = ALPHA) -> Transitions:
    """The iteration as rows (src, dst, weight); dst null means the source.

    Rows are partitioned and sorted once, in the checkpoint folder, and every
    iteration reads them in place.  A hub's rows are spread over slots.
    """
    flagged = checkpointed(_multiplicities(nodes, edges))
    stats = checkpointed(_out_stats(flagged))
    hot = checkpointed(hot_keys(stats, ["src"]))
    follow = F.lit(1.0 - alpha)
    links = (
        salt_many(flagged.where("known"), hot, ["src"], ["dst"])
        .join(salt_one(stats, hot, ["src"]), ["src", "slot"])
        .select("src", "slot", "dst", (follow * F.col("m") / F.col("outdegree")).alias("weight"))
    )
    kept_share = F.coalesce(F.col("kept") / F.col("outdegree"), F.lit(0.0))
    restarts = _unique(nodes).withColumnRenamed("id", "src").join(stats, "src", "left").select(
        "src", F.lit(0).alias("slot"), F.lit(None).cast("bigint").alias("dst"),
        (1.0 - follow * kept_share).alias("weight"),
    )
    return Transitions(checkpointed_by(links.unionByName(restarts), ["src", "slot"]), hot)


def iterate(ranks: DataFrame, graph: Transitions) -> DataFrame:
    """The ranks one iteration later."""
    senders = salt_one(ranks.withColumnRenamed("id", "src"), graph.hot, ["src"])
    sent = graph.steps.join(senders, ["src", "slot"])
    return (
        sent.groupBy("source", F.coalesce("dst", "source").alias("id"))
        .agg(F.sum(F.col("p") * F.col("weight")).alias("p")).where("p > 0")
    )


def snapshot_path(base: str, iteration: int) -> str:
    return f"{base}/iter{iteration:04d}"


def pagerank(
    nodes: DataFrame,
    edges: DataFrame,
    sources: Sequence[int],
    end: int,
    start: int = 0,
    base: str | None = None,
    alpha: float = ALPHA,
    checkpoint_every: int = CHECKPOINT_EVERY,
) -> DataFrame:
    """(source, id, p > 0) after iterations ``start`` .. ``end``.

    With ``base``, the ranks are stored there as numbered snapshots every
    ``checkpoint_every`` iterations and at the end, and a ``start`` above 0
    resumes from the snapshot of that number.  Without it, lineage is cut at
    the same steps in the checkpoint folder.
    """
    if start and not base:
        raise ValueError("resuming needs the base folder of the snapshots")
    spark = nodes.sparkSession
    ranks = spark.read.parquet(snapshot_path(base, start)) if start else init_ranks(nodes, sources)
    staging = Staging(spark, "ranks")
    if end > start:
        graph = transitions(nodes, edges, alpha)
    for done in range(start + 1, end + 1):
        ranks = iterate(ranks, graph)
        if base and (done == end or done % checkpoint_every == 0):
            ranks.write.mode("overwrite").parquet(snapshot_path(base, done))
            ranks = spark.read.parquet(snapshot_path(base, done))
        elif done < end and done % checkpoint_every == 0:
            before, ranks = ranks, staging.keep(ranks, "ranks")
            staging.drop(before)  # its only reader was the step just stored
    return ranks


def dense_ranks(ranks: DataFrame, nodes: DataFrame, sources: Sequence[int]) -> DataFrame:
    """(source, id, p) with a row for every node, 0 where no probability arrived."""
    each = F.explode(F.lit([int(s) for s in dict.fromkeys(sources)]).cast("array<bigint>"))
    spine = nodes.select(each.alias("source"), "id")
    filled = spine.join(ranks, ["source", "id"], "left")
    return filled.select("source", "id", F.coalesce("p", F.lit(0.0)).alias("p"))


def mass_balance(ranks: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(source, mass, missing): probability the next iteration passes along
    edges to nodes, and the rest, which returns to the source."""
    stats = _out_stats(_multiplicities(nodes, edges)).withColumnRenamed("src", "id")
    passed = ranks.join(stats, "id", "left").select(
        "source", F.coalesce(F.col("p") * F.col("kept") / F.col("outdegree"), F.lit(0.0)).alias("m")
    )
    mass = passed.groupBy("source").agg(F.sum("m").alias("mass"))
    return mass.select("source", "mass", F.greatest(1.0 - F.col("mass"), F.lit(0.0)).alias("missing"))


def top_nodes(ranks: DataFrame, n: int, digits: int = 10) -> DataFrame:
    """(source, rank, id, p): the ``n`` most probable nodes of each source.

    Probabilities equal in their first ``digits`` significant digits tie and go
    by id: sums that differ only in the order of their terms do not decide, and
    probabilities of any size are told apart.  Filtering on the row number lets
    Spark drop rows below the n-th before the shuffle.
    """
    comparable = F.format_string(f"%.{digits - 1}e", "p").cast("double")
    order = Window.partitionBy("source").orderBy(comparable.desc(), F.asc("id"))
    numbered = ranks.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return numbered.select("source", "rank", "id", "p")
