"""Connected components of a graph of links, by alternating large-star and small-star steps.

Every step is a join and an aggregate on the links, which are replaced by links to smaller neighbours
until each component is a star around its smallest node. Only two sums a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractflow.llm.store import discard, written


def _both(links: DataFrame) -> DataFrame:
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.select("a", "b").union(turned)


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours; links may repeat."""
    both = _both(links)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them. Links point from a down to b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    tied = links.join(least, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def _print(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Null ends, repeated links and links of a node to itself are dropped; no links give no rows. ``rows``: as in ``written``.
    """
    pointed = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = written(pointed, "links", rows)
    state = _print(now)
    while state[0]:
        old, now = now, written(_small_star(_large_star(now)), "links", rows)
        discard(old)
        before, state = state, _print(now)
        if state == before:
            break
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def roots(parents: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component) of a forest (node, parent) in which every parent is smaller than its node.

    Nodes look up their parents' parents until nothing changes: as many rounds as the logarithm of the depth.
    """
    now = written(parents.select("node", F.col("parent").alias("component")), "roots", rows)
    while True:
        above = now.select(F.col("node").alias("component"), F.col("component").alias("higher"))
        old, step = now, written(now.join(above, "component", "left").select("node", F.coalesce("higher", "component").alias("component"), F.col("higher").isNotNull().alias("moved")), "roots", rows)
        discard(old)
        now = step.drop("moved")
        now.stored_at = step.stored_at
        if step.where("moved").isEmpty():
            break
    return now.union(now.select(F.col("component").alias("node"), "component").distinct())
