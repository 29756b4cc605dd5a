"""Connected components of a table of links, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a long, b long); the component is its smallest node.

    Every step is a grouped minimum and a join, so a node with very many links is one row per task after partial
    aggregation and a splittable side of the join. Each round is written to the shared folder.
    """
    both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges, last = saved(both, "links"), None
    while True:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written first: a join straight on an aggregation could not be split at a node with very many links
        least = saved(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least-links")
        large = around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = saved(large.groupBy("a").agg(F.min("b").alias("m")), "least-links")
        small = large.join(least, "a")
        small = (small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b")))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
        edges = saved(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.countDistinct("a")).first()
        # a forest of stars (each node points at one root, and no root points on) is final
        if now[0] == now[2] and tuple(now) == last:
            break
        last = tuple(now)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
