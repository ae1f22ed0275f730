"""Connected components of links, by joins and groupings.

Rounds of large-star and small-star (Kiveris et al., 2014) turn any links into
stars around the smallest vertex of each component.  Every round is one table
in the shared folder; nothing is collected but whether a round changed
anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import Staging


def _smallest_neighbour(links: DataFrame) -> DataFrame:
    """(u, m) with the smallest of u and its neighbours."""
    return links.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m"))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def star_forest(staging: Staging, links: DataFrame) -> DataFrame:
    """(v, u): each vertex that is not the smallest of its component, with that smallest.

    ``links`` has columns u and v of any type with an order.
    """
    stars = staging.keep(
        links.select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u")).where("u < v").distinct(),
        "links",
    )
    while True:
        done = stars.select("u").join(stars.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()
        if done and stars.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return stars
        sym = _both_ways(stars.select("u", "v"))
        large = (
            sym.join(_smallest_neighbour(sym), "u").where("v > u").select("v", F.col("m").alias("u")).distinct()
        )
        # small star: smaller neighbours of a vertex, and itself, go to the smallest of them
        down = large.where("u < v").select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").select("v", F.col("m").alias("u"))
        own = least.select(F.col("u").alias("v"), F.col("m").alias("u"))
        after = staging.keep(moved.unionAll(own).where("u < v").distinct(), "stars")
        staging.drop(stars)
        stars = after
