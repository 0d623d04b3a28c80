"""Connected components of edges that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumstone.llm.common import freeze


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: the smallest node reachable from each node that has an edge.

    Alternating stars (Kiveris et al., "Connected components in MapReduce and beyond"): every node
    hands its larger neighbours, then its smaller ones, to the smallest node it sees, until all
    point at their root.  Only minima are aggregated and joined back, so a node with very many
    neighbours is spread over tasks; each round is frozen.
    """
    larger, smaller = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    links = freeze(edges.filter(F.col(a) != F.col(b)).select(larger, smaller).distinct(), "stars")
    before = None
    while True:
        sign = links.agg(F.count("u"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if tuple(sign) == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = tuple(sign)
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        grown = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        grown = grown.filter("u <> v").distinct()
        least = grown.groupBy("u").agg(F.min("v").alias("m"))
        moved = grown.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
        links = freeze(moved.filter("u <> v").distinct(), "stars")
