"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quayside.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """`links` (a, b), any order, repeats allowed -> (node, root): root is the smallest node reachable.

    Each round hangs every node's larger neighbours on its smallest one, then
    each node's smaller neighbours and itself on the smallest of them, until
    nothing moves. Minima are aggregated before they are shuffled, a hub of a
    star is a hot join key that can be split, and a round's links are written
    out, so a lost executor goes back one round at most. A node without a link
    to another is not in the result.
    """
    edges = saved(_ordered(links.select("a", "b")), "links")
    while True:
        large = _hung(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        stars = saved(_hung(_ordered(large), larger=False), "links")
        # done when every link leads from a root that is nobody's follower, once from each follower
        ends = stars.select(F.col("b").alias("n"), F.lit(0).alias("head"), F.lit(1).alias("tail")).unionByName(
            stars.select(F.col("a").alias("n"), F.lit(1).alias("head"), F.lit(0).alias("tail")))
        seen = ends.groupBy("n").agg(F.max("head").alias("head"), F.sum("tail").alias("tail"))
        if seen.filter("tail > 1 or (head = 1 and tail > 0)").isEmpty():
            return stars.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                stars.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        edges = stars


def _ordered(links: DataFrame) -> DataFrame:
    """Smaller node first, each link once, no loops."""
    return links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _hung(links: DataFrame, larger: bool) -> DataFrame:
    """Links from the smallest node around each hub to the hub's larger (or smaller) neighbours."""
    hub, other = ("a", "b") if larger else ("b", "a")
    low = links.groupBy(F.col(hub).alias("hub")).agg(F.least(F.min(other), F.col("hub")).alias("low"))
    around = links.select(F.col(hub).alias("hub"), F.col(other).alias("other")).join(low, "hub")
    if larger:
        moved = around.filter("other > hub").select(F.col("low").alias("a"), F.col("other").alias("b"))
    else:
        moved = around.select(F.col("low").alias("a"), F.col("other").alias("b")).unionByName(
            low.select(F.col("low").alias("a"), F.col("hub").alias("b")))
    return moved.filter("a <> b").distinct()
