"""Classes of linked nodes, worked out by Spark round by round: stars are re-hung on their smallest node until nothing moves.

Every round is joins and grouped minima over the links, written to the shared folder; no node's links meet in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node of its neighbourhood."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    own = least.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(own).filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node of each linked node's component. ``links``: u, v."""
    links = written(links.filter("u != v").distinct(), "links")
    state = None
    while True:
        links = written(_small_star(_large_star(links)), "links")
        now = links.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def joined_classes(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` (node, cls) after the nodes of each link (a, b) have come into one class."""
    a, b = (classes.select(F.col("node").alias(x), F.col("cls").alias(f"cls_{x}")) for x in "ab")
    lifted = links.join(a, "a").join(b, "b").select(F.col("cls_a").alias("u"), F.col("cls_b").alias("v"))
    moved = components(lifted).select(F.col("node").alias("cls"), "root")
    return written(classes.join(moved, "cls", "left").select("node", F.coalesce("root", "cls").alias("cls")), "classes")
