"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.session import stored


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the smallest of u and its neighbours as ``m``."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")))
    # both sides are plain shuffles, so a hub is split like any other hot key
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every node of the edges (u, v).

    Each round links the neighbours of a node to the smallest of them, first the larger ones,
    then the smaller ones; in the end each component is a star. Edges never grow in number.
    """
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_to_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        near = _to_smallest(large)
        edges = stored(
            near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(large.join(
                large.groupBy("u").agg(F.min("v").alias("m")), "u").select("u", F.col("m").alias("v"))).distinct()
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct(),
    )
