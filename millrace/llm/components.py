"""Connected components of a graph whose edges are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.words import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of an edge (a, b); component is the smallest node that it reaches.

    Alternates two steps until the edges are stars around the smallest nodes: every node hands its larger neighbours to its
    smallest one, then its smaller neighbours too. Each step is an aggregate and a join; the edges between
    rounds are written to the shared folder. Edges with a null end are no edges, repeated edges count once.
    """
    stars = saved(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    before = _digest(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = saved(small.unionByName(root.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _digest(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.sum(F.xxhash64("v", "u", F.lit(1)).cast("decimal(20,0)"))).first()
    )
