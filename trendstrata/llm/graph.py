"""Connected components of an edge table, without bringing a vertex's edges into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstrata.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``v, label`` for every vertex of the edges; the label is the smallest vertex of its component.

    Alternating large-star and small-star steps.  Each step takes the least
    neighbour of a vertex (an aggregate that combines before its shuffle) and
    joins it to the vertex's edges (a join whose large keys can be split).
    Edges are written after each round, so a lost executor repeats one round at most.
    """
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    current = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "edges")
    before = current.agg(F.count(F.lit(1)), mark).first()
    while before[0]:
        both = current.unionAll(current.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.min("b").alias("_b")).select("a", F.least("a", "_b").alias("m")), "least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large-star")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        joined = large.join(least, "a")
        small = joined.select("a", F.col("m").alias("b")).unionAll(joined.filter("b <> m").select("b", "m"))
        current = stored(small.distinct(), "small-star")
        after = current.agg(F.count(F.lit(1)), mark).first()
        if after == before:
            break
        before = after
    labels = current.select(F.col("a").alias("v"), F.col("b").alias("label"))
    return labels.unionAll(current.select("b", "b").distinct())
