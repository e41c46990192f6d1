"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.session import materialize


def _to_least(pairs: DataFrame) -> DataFrame:
    """Per ``u`` the least of itself and its ``v``; every ``v`` linked to it."""
    least = pairs.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    return pairs.join(least, "u").select("u", "v", "m")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: the least node of each component, for every node of a link between two nodes.

    Each step replaces links by links to least neighbours: first those of larger neighbours, then those of
    smaller ones. When a step changes nothing, links are stars around the roots. The number of steps
    grows with the logarithm of the nodes; only counts and sums come to the driver.
    """
    edges = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = materialize(edges, "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        stars = _to_least(down)
        small = stars.select(F.col("v").alias("u"), F.col("m").alias("v")).union(stars.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter(F.col("u") != F.col("v")).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == now:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
