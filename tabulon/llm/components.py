"""Connected components by alternating large-star and small-star rounds.

Edges are rows all the way; every round is two aggregations, so a node with very many
neighbours is partial minima in many tasks. The rounds end when the edges no longer
change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (id, component): the least id reachable, for every id that has a
    link; NULL ids must be mapped before. No links give no rows."""
    e = stored(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .distinct(), "cc")
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        last, e = e, stored(small, "cc")
        discard(last)
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct())
