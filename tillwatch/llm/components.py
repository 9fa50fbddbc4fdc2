"""Connected components of a link table by repeated stars, every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.shared import discard, stored


def components(links: DataFrame, a: str = "a", b: str = "b", scratch: list[DataFrame] | None = None) -> DataFrame:
    """node, component (its smallest reachable node) of every linked node; links have any direction.

    Large stars hang every larger neighbour on a node's smallest one, small stars hang the smaller
    neighbours and the node itself there.  Both keep connectivity; they end in one star per component.
    Rows of a node meet only in a minimum, which aggregates before the shuffle, and in a join.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = stored(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        after = stored(small, "edges")
        same = after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty()
        discard(large, edges)
        if same:
            if scratch is not None:
                scratch.append(after)
            break
        edges = after
    stars = after.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
