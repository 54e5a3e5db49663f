"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined on the map side) joined back to the
links, so a node with very many links is split by the skew join and no list of
neighbours is ever collected. Links are written to the shared folder after each
round, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.session import settle


def _is_open(links: DataFrame) -> bool:
    """Whether some node has two links down, or a link down to a node that has one itself."""
    several = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    onward = links.join(links.select(F.col("a").alias("b")), "b", "left_semi").select("a")
    return bool(several.unionByName(onward).take(1))


def _to_minimum(links: DataFrame) -> DataFrame:
    """(a, b, m): each link with the smallest of a and all its b."""
    # Settled, so that the join sees two plain sides and can split a hot node.
    lowest = settle(links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    return links.join(lowest, "a")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); root is the smallest node of its component.

    Null nodes and links of a node with itself are ignored; repeated links count once.
    The rounds end once every node has one link, and that to a node without one: then each
    component is a star around its smallest node.
    """
    links = links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    links = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while _is_open(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = settle(_to_minimum(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        near = _to_minimum(large)
        small = near.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = settle(small.unionByName(near.select("a", F.col("m").alias("b"))).distinct())
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
