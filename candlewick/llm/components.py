"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise


def _with_lowest(links: DataFrame) -> DataFrame:
    """Each (u, v) with the lowest node of u's neighbourhood, u included."""
    lowest = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return links.join(lowest, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its lowest reachable node) of every node on an edge (``a``, ``b``).

    Alternates large-star and small-star steps until nothing moves.  The number of edges never
    grows, each step is a grouped minimum and a join, so a hub with a third of all edges is
    aggregated before the shuffle and split by adaptive execution, and every round is a written table.
    """
    pairs = edges.filter(F.col("a") != F.col("b"))
    links = materialise(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Larger neighbours go to the lowest node around u.
        large = _with_lowest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large-star")
        # u and its smaller neighbours go to the lowest of them.
        small = _with_lowest(large)
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        own = small.select("u", F.col("m").alias("v"))
        links = materialise(moved.unionByName(own).distinct(), "small-star")
        state = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        now = tuple(state.first())
        if now == before:
            break
        before = now
    tops = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
