"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.workspace import hold


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node it reaches.

    Every round attaches each node's larger neighbours to its smallest one (large star), then the
    smaller ones too (small star), until the links are stars around the smallest nodes. The number
    of links never grows and rounds grow with the logarithm of the size. A node with many links is
    one row after map-side minimum, and its join is one that Spark may split. Rounds are written to
    the shared folder; the driver sees two numbers per round.
    """
    a, b = F.col(left), F.col(right)
    edges = hold(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        seen = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = hold(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = hold(least.select("u", F.col("m").alias("v")).union(small).distinct(), "small-star")
