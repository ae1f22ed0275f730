"""Adjacency lists and source lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .documents import read_lines


def parse_adjacency(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes(id) and edges(src, dst) from lines ``id n1 n2 ...``.

    A lone id is a node without out-edges; a repeated neighbour is a repeated
    edge.
    """
    ids = F.split(F.regexp_replace("text", r"^\s+|\s+$", ""), r"\s+").cast("array<bigint>")
    rows = lines.where(F.col("text").rlike(r"\S")).select(ids.alias("ids"))
    nodes = rows.select(F.col("ids")[0].alias("id"))
    neighbours = F.slice("ids", 2, F.size("ids"))
    edges = rows.select(F.col("ids")[0].alias("src"), F.explode(neighbours).alias("dst"))
    return nodes, edges


def read_adjacency(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_adjacency(read_lines(spark, path))


def read_sources(text: str) -> list[int]:
    """Source ids from a comma-separated argument."""
    return [int(s) for s in text.split(",")]
