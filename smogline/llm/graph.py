"""Connected components of a graph kept in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.session import cut


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node of an edge.

    ``edges`` has long columns ``u`` and ``v``; direction, repeats and loops do not matter,
    rows with a null end are no edges. Alternating star contraction: every round ties a
    node's larger neighbours to its smallest one, then its smaller neighbours as well, until
    all edges are stars around the smallest nodes; rounds grow with the logarithm of the
    longest path. Minima are combined on the map side, a round's edges are written to the
    shared folder, only a count and a checksum reach the driver.
    """
    edges = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        edges = cut(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
