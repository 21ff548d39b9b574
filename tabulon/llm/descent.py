"""Where a running sum meets a budget, found without sorting.

Rows carry a group, a position in [0, 1) and an amount. For every group the position is
wanted at which the amounts before it reach the group's budget. Each level splits the
group's current interval into equal buckets, sums them (an aggregation with map-side
combining: at most groups x buckets rows), and goes on with the bucket in which the
budget falls. No row is ever sorted, and a hot group is only a few more partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import discard, stored

BUCKETS = 1024


def cuts(rows: DataFrame, groups: DataFrame, group: str, position: Column, amount: Column,
         budget: str = "budget", levels: int = 4, label: str = "cuts", few: bool | None = None, most: int = 100_000) -> DataFrame:
    """``groups`` (one row per group: the group key and its budget) with three more columns:
    ``cut_lo``, ``cut_hi``: the last interval, and ``cut_below``: the amount of the group's
    rows before ``cut_lo``; ``cut_in``: the amount inside the interval.

    Rows with position < cut_lo sum to at most the budget, and the amount inside
    [cut_lo, cut_hi) goes beyond it. A group whose rows never exceed its budget gets the
    interval [1, 1]. Groups without rows get it too. Up to ``most`` groups (four numbers
    each) are broadcast to the rows; more are joined by a shuffle. ``few`` says which, where
    the caller has counted them.
    """
    if few is None:
        few = groups.limit(most + 1).count() <= most
    state = groups.withColumns({"cut_lo": F.lit(0.0), "cut_hi": F.lit(1.0), "cut_below": F.lit(0.0),
                                "cut_in": F.lit(0.0)})
    names = [c for c in state.columns if not c.startswith("cut_")]
    src = rows.select(F.col(group).alias("__g"), position.alias("__p"), amount.cast("double").alias("__a"))
    for _ in range(levels):
        at = state.select(F.col(group).alias("__g"), "cut_lo", "cut_hi")
        at = F.broadcast(at) if few else at
        width = F.col("cut_hi") - F.col("cut_lo")
        inside = (src.join(at, "__g").where("__p >= cut_lo and __p < cut_hi")
                  .groupBy("__g", F.least(F.floor((F.col("__p") - F.col("cut_lo")) / width * BUCKETS),
                                          F.lit(BUCKETS - 1)).alias("__b"))
                  .agg(F.sum("__a").alias("__s")))
        run = Window.partitionBy("__g").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        before = inside.withColumn("__before", F.coalesce(F.sum("__s").over(run), F.lit(0.0)))
        hit = (before.join(state.select(F.col(group).alias("__g"), F.col(budget).alias("__budget"), "cut_below"), "__g")
               .where(F.col("cut_below") + F.col("__before") + F.col("__s") > F.col("__budget"))
               .groupBy("__g").agg(F.min_by(F.struct("__b", "__before", "__s"), "__b").alias("__hit")))
        joined = state.join(hit.withColumnRenamed("__g", group), group, "left")
        found, first = F.col("__hit").isNotNull(), F.col("cut_hi") == F.lit(1.0)
        step = (F.col("cut_hi") - F.col("cut_lo")) / BUCKETS
        low = F.col("cut_lo") + step * F.col("__hit.__b")
        last, state = state, stored(joined.select(
            *names,
            F.when(found, low).when(first & (F.col("cut_lo") == 0), F.lit(1.0)).otherwise(F.col("cut_lo")).alias("cut_lo"),
            F.when(found, low + step).otherwise(F.col("cut_hi")).alias("cut_hi"),
            F.when(found, F.col("cut_below") + F.col("__hit.__before")).otherwise(F.col("cut_below")).alias("cut_below"),
            F.when(found, F.col("__hit.__s")).otherwise(F.col("cut_in")).alias("cut_in")), label)
        discard(last)
    return state


def nearer(budget: str = "budget") -> Column:
    """End of what is taken: with the last interval if that is nearer to the budget."""
    over = F.col("cut_below") + F.col("cut_in") - F.col(budget)
    return F.when(over < F.col(budget) - F.col("cut_below"), F.col("cut_hi")).otherwise(F.col("cut_lo"))
