"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: columns a and b, ids of any ordered type. Returns id and component, the smallest id reachable from id.

    Ids with no edge to another id are not in the result. Each round links every node with the smallest node it sees,
    which takes a number of rounds that grows with the logarithm of the longest path. Rounds are written to the shared
    folder, and only a count and a checksum of each reach the driver.
    """
    edges = materialize(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        near = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(near, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        near = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(near, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(near.select("a", F.col("m").alias("b")))
        small = small.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges = materialize(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots.select("id", F.col("id").alias("component")))
