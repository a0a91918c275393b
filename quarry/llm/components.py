"""Connected components by alternating large-star and small-star steps.

Each step is a grouping and a join on the node; every iteration is written to the shared
folder.  Nodes with more than ``HUB`` links are hubs: their links stay where they are and
meet the hubs' labels by broadcast, so no task holds all links of one node.  There are at
most ``2 * links / HUB`` hubs; above ``BROADCAST_ROWS`` of them (then over a billion links) the
adaptive skew join splits them instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise


HUB = 1_000
BROADCAST_ROWS = 1_000_000   # two nodes of at most 16 bytes each


def _labelled(links: DataFrame, least: DataFrame) -> DataFrame:
    """``links`` (u, v) with the label m of u, from ``least`` (u, m, links)."""
    hubs = least.filter(F.col("links") > HUB).select("u", "m")
    n = hubs.count()
    if not 0 < n <= BROADCAST_ROWS:
        return links.join(least.select("u", "m"), "u")
    hubs = F.broadcast(hubs)
    few = links.join(hubs.select("u"), "u", "left_anti").join(least.filter(F.col("links") <= HUB).select("u", "m"), "u")
    return few.union(links.join(hubs, "u"))


def _stars(e: DataFrame) -> bool:
    """Whether every node hangs on one other that hangs on none: the components are found."""
    if not e.groupBy("u").count().filter("count > 1").isEmpty():
        return False
    return e.join(e.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with a link to another; the component is its least node."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e = materialise(e, "links")
    while not _stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("links"))
        least = materialise(least.select("u", F.least("u", "m").alias("m"), "links"), "least")
        large = _labelled(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        e = materialise(small, "small")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
