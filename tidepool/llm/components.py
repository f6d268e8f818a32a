"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest one (itself counts)."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links(a, b): component is the smallest node reachable.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest chain.
    """
    links = materialise(links.filter("a <> b").select("a", "b").distinct())
    state = None
    while True:
        new = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if new == state or not new["n"]:
            break
        state = new
        links = materialise(_small_star(_large_star(links)))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select(F.col("b"), F.col("b")).distinct())
