"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``links`` (a, b) reaches.

    Alternates two steps until nothing moves. The large step points the larger
    neighbours of every node at its smallest neighbour, the small step points
    its smaller neighbours there; each is a minimum per node, combined before
    the shuffle, and a join back that AQE splits at a hub. A round is written
    to the shared folder, so that a lost executor costs that round alone; the
    number of rounds grows with the logarithm of the longest chain. No link
    leaves the cluster: a round returns two counts to the driver.

    Links are one per pair of nodes at most; loops and nulls are ignored. No
    links give no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(edges.filter("u > v").distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = written(_point(both, larger=True), "large")
        edges = written(_point(edges, larger=False), "small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
                             .distinct())


def _point(edges: DataFrame, larger: bool) -> DataFrame:
    """Links (u, v) from neighbours of every node to the smallest of them and it.

    ``larger``: neighbours above the node; otherwise those below it, and the
    node itself.
    """
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = edges.join(least, "u")
    if larger:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()
