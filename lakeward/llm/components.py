"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.session import settled


def connected_components(links: DataFrame) -> DataFrame:
    """The smallest node that each node of `links` (a, b) can reach, as (node, component).

    Alternates large-star and small-star rounds, which halve the depth of the trees: the
    neighbours of a node that are larger than it, then those that are smaller, are hung on
    the smallest of them. A star is one minimum per node joined back to its links, so a node
    with very many links needs no list of them. Each round is written, which cuts the
    lineage; only a count of the changed links reaches the driver. Links of a node with
    itself and repeated links do no harm.
    """
    edges = settled(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links"
    )
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: each larger neighbour of u hangs on the smallest node seen from u.
        large = (
            edges.select(F.col("v").alias("u"), F.col("u").alias("w"))
            .join(least, "u")
            .select(F.col("w").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        large = settled(large, "large")
        # Small star: each smaller neighbour of u, and u, hang on the smallest neighbour.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        after = settled(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "small")
        if after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty():
            stars = after.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
        edges = after
