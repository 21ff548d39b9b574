"""Equi-joins on a shared key, and a size-checked broadcast for small sides.

The six join types are Spark's own; the planner (with AQE) chooses sort-merge,
shuffled-hash or broadcast by runtime size. ``with_small`` is for attaching a
small, *checked* table (group statistics, lookups) to a large one without
shuffling the large side on a low-cardinality key — such a shuffle would send all
rows of a hot key to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.session import cut_lineage

JOIN_TYPES = ("inner", "left", "right", "outer", "leftsemi", "leftanti")

# Largest small side (rows) that is collected and broadcast; beyond it the join
# shuffles both sides on the key (AQE splits skewed partitions).
MAX_BROADCAST_ROWS = 100_000

# Most cells of the grid of a key that is hot on both sides.
MAX_CELLS = 1_024

# Rows of both sides that one task of a join without hot keys sorts.
ROWS_A_JOIN_TASK = 1_000_000


def equi_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str) -> DataFrame:
    """Join on shared column name(s); the key appears once (coalesced for right/outer)."""
    if how not in JOIN_TYPES:
        raise ValueError(f"join type {how!r} not in {JOIN_TYPES}")
    return left.join(right, on=on, how=how)


def _null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join in which a NULL key equals a NULL key; the key appears once."""
    other = right.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(on)],
                         *[F.col(f"`{c}`") for c in right.columns if c not in on])
    cond = [F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(on)]
    return left.join(other, cond, how).drop(*[f"__k{i}" for i in range(len(on))])


def with_small(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left",
               max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join ``small`` onto ``big`` (inner or left; a NULL key equals a NULL key),
    broadcasting ``small`` only if it has <= max_rows rows.

    ``small`` is computed once, written to the shared checkpoint folder and counted
    there; beyond the bound the same rows are joined by a shuffle.
    """
    on = [on] if isinstance(on, str) else list(on)
    small = cut_lineage(small)
    fits = small.count() <= max_rows
    return _null_safe(big, F.broadcast(small) if fits else small, on, how)


def grid_parts(n: Column, m: Column, rows_per_task: int) -> tuple[Column, Column]:
    """Into how many parts the ``n`` left and ``m`` right rows of a hot key are dealt: parts of
    ``rows_per_task`` rows, or, where their grid would have over ``MAX_CELLS`` cells, the grid
    of about that many that repeats the fewest rows."""
    i, j = F.ceil(n / rows_per_task), F.ceil(m / rows_per_task)
    fewer = F.least(i, F.greatest(F.lit(1), F.ceil(F.sqrt(MAX_CELLS * F.try_divide(n, m)))))
    large = i * j > MAX_CELLS
    return (F.when(large, fewer).otherwise(i).cast("int"),
            F.when(large, F.least(j, F.ceil(MAX_CELLS / fewer))).otherwise(j).cast("int"))


def skew_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner",
              rows_per_task: int = 1_000_000) -> DataFrame:
    """``equi_join`` of any of the six types for keys that are hot on either side, or on both.

    Keys with more than ``rows_per_task`` rows on a side are counted apart (there are at most
    rows / rows_per_task of them a side). A hot key on both sides fills a grid: its left rows
    are dealt into i parts and its right rows into j, and every left part meets every right
    part in a cell. A part holds ``rows_per_task`` rows, or more where the grid would have
    over ``MAX_CELLS`` cells: a row is written once for every part of the other side, so
    cells without a bound would make the shuffle grow with the square of the input. All rows
    meet in one join on the key and the cell, so what follows the join runs within its stage.
    A hot key that the other side lacks, and NULL keys, which match nothing, are dealt over
    parts alone. A semi join takes the left rows of keys hot on both sides as they are, an
    anti join none of them; there rows with a NULL key are not shuffled.

    These rows get their parts by their place in the scan, so equal rows spread too; they
    are written to the shared folder with them, so a repeated task reads the same parts.

    Where no key is hot, NULL ones included, the join is a plain one, with so many partitions
    that one has about ``ROWS_A_JOIN_TASK`` rows of both sides together.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"join type {how!r} not in {JOIN_TYPES}")
    on = [on] if isinstance(on, str) else list(on)
    names = equi_join(left, right, on, how).columns
    keys = [f"__k{i}" for i in range(len(on))]

    def own(df, letter):
        rest = [c for c in df.columns if c not in on]
        return df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)],
                         *[F.col(f"`{c}`").alias(f"__{letter}{i}") for i, c in enumerate(rest)])

    a, b = own(left, "l"), own(right, "r")
    exists = how in ("leftsemi", "leftanti")
    out = [*keys, *a.columns[len(on):], *([] if exists else b.columns[len(on):])]
    given = F.lit(True)
    for k in keys:
        given = given & F.col(k).isNotNull()

    def counted(df, name):
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    # a side's counts are about as many as its rows, so they are filtered before they meet
    many = [cut_lineage(counted(df, "__n").where(F.col("__n") > rows_per_task)) for df in (a, b)]
    if many[0].isEmpty() and many[1].isEmpty():
        parts = -(-(a.count() + b.count()) // ROWS_A_JOIN_TASK)
        if parts > left.sparkSession.sparkContext.defaultParallelism:  # else Spark's own number
            a, b = a.repartition(parts, *keys), b.repartition(parts, *keys)
        return a.join(b, keys, how).select(*out).toDF(*names)
    over = many[0].select(*keys).unionByName(many[1].select(*keys)).where(given).distinct()
    small = over.count() <= MAX_BROADCAST_ROWS

    def counted_over(df, name):
        return counted(df.join(F.broadcast(over) if small else over, keys, "leftsemi"), name)

    n, m = F.coalesce("__n", F.lit(0)), F.coalesce("__m", F.lit(0))
    i, j = grid_parts(n, m, rows_per_task)
    hot = cut_lineage(counted_over(a, "__n").join(counted_over(b, "__m"), keys, "outer")
                      .select(*keys, i.alias("__i"), j.alias("__j")))
    with_hot = lambda df, kind: df.where(given).join(F.broadcast(hot) if small else hot, keys, kind)
    if exists:
        total = with_hot(a, "leftanti").join(with_hot(b, "leftanti"), keys, how).select(*out)
        if how == "leftanti":
            more = [a.where(~given), with_hot(a, "inner").where("__j = 0")]
        else:
            more = [with_hot(a, "inner").where("__j > 0")]
        for part in more:
            total = total.unionByName(part.select(*out))
        return total.toDF(*names)

    def dealt(df, mine, others, at, beside, alone):
        """The rows with their cells; ``alone``: also those that meet nothing."""
        apart = with_hot(df, "inner")
        if alone:
            apart = apart.unionByName(df.where(~given).withColumns({mine: F.lit(MAX_CELLS), others: F.lit(0)}))
        else:
            apart = apart.where(F.col(others) > 0)
        apart = cut_lineage(apart.withColumn(at, F.pmod(F.monotonically_increasing_id(), F.col(mine)).cast("int")))
        apart = apart.withColumns({"__grid": F.col(others) > 0,
                                   beside: F.explode(F.sequence(F.lit(0), F.greatest(F.col(others) - 1, F.lit(0))))})
        plain = with_hot(df, "leftanti").withColumns({"__grid": F.lit(False), at: F.lit(0), beside: F.lit(0)})
        return plain.unionByName(apart.drop(mine, others))

    x = dealt(a, "__i", "__j", "__x", "__y", how in ("left", "outer")).withColumnRenamed("__grid", "__in_x")
    y = dealt(b, "__j", "__i", "__y", "__x", how in ("right", "outer")).withColumnRenamed("__grid", "__in_y")
    total = x.join(y, [*keys, "__x", "__y"], how)
    # in a grid every row has its partners, but not in each of its cells
    if how in ("left", "outer"):
        total = total.where(F.col("__in_y").isNotNull() | ~F.col("__in_x"))
    if how in ("right", "outer"):
        total = total.where(F.col("__in_x").isNotNull() | ~F.col("__in_y"))
    return total.select(*out).toDF(*names)


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                rows_per_task: int = 1_000_000) -> DataFrame:
    """``skew_join`` under its earlier name."""
    return skew_join(left, right, on, how, rows_per_task)
