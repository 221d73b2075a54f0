"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps, which need O(log^2 n) rounds in theory and a
few in practice. Each step is an aggregation and a join; the round's edges are stored in
the shared folder, so lineage stays short and nothing of the graph reaches the driver. Of
past rounds nothing is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrecords.llm.common import forget, stored


def _star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges u, v with the least neighbour m of u, or u itself; and what was stored for it."""
    # Stored: with an exchange on either side of the join, Spark can split a hub's edges.
    least = stored(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "components-least")
    return edges.join(least, "u"), least


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root``: for each node with an edge the least node of its component.

    Loops and repeated edges are allowed; rows with a NULL end are left out.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u IS NOT NULL AND u > v").distinct()
    now, before = stored(now, "components"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        star, least = _star(both)
        large = star.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "components-large")
        forget(now, least)
        star, least = _star(large)
        small = star.select("v", "m").filter("v > m").unionByName(star.select(F.col("u").alias("v"), "m"))
        now = stored(small.distinct().select(F.col("v").alias("u"), F.col("m").alias("v")), "components")
        forget(large, least)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
