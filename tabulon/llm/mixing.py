"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a budget of words by its weight. As many complete epochs of a source
as fit its budget are taken whole; what is left is drawn without replacement with
chances by document quality: each document has an exponential key with its quality as
rate, documents are taken in the order of their keys, and the running sum of their sizes
is cut at the budget.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.common import n_words, packed, stored, table, unit_hash
from tabulon.llm.descent import cuts

#: Sources that the driver will share budgets out to (a row of totals each).
MAX_SOURCES = 100_000
#: Rounds that fill a source's budget.
ROUNDS = 3


def cyclic_weights(sources: Sequence[str | None]) -> list[float]:
    """1, 2, 3, repeating, over the sources in order of code points, NULL last."""
    order = sorted(range(len(sources)), key=lambda i: (sources[i] is None, sources[i] or ""))
    out = [0.0] * len(sources)
    for rank, i in enumerate(order):
        out[i] = 1.0 + rank % 3
    return out


def share_out(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = 3.0) -> list[float]:
    """Targets that share ``total`` by weight; none is above ``most`` times its source's
    size, and what that cuts off is shared again among the others."""
    out = [0.0] * len(sizes)
    free = {i for i in range(len(sizes)) if weights[i] > 0}
    left = float(total)
    while free:
        rate = left / sum(weights[i] for i in sorted(free))
        full = {i for i in free if weights[i] * rate >= most * sizes[i]}
        if not full:
            for i in free:
                out[i] = weights[i] * rate
            break
        for i in sorted(full):
            out[i] = most * sizes[i]
            left -= out[i]
        free -= full
    return out


def quality(text: Column) -> Column:
    """Quality weight of a document, 0.25 to 1: the share of letters, digits and plain
    sentence marks among its characters, squared, above a floor. Missing text: 0.25."""
    n = F.char_length(text)
    odd = n - F.char_length(F.translate(text, "#*$%&|<>{}[]\\^~_=+@!", ""))
    return F.when(n > 0, 0.25 + 0.75 * F.pow(1.0 - odd / n, 2)).otherwise(F.lit(0.25))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Callable[[Sequence[str | None]], list[float]] = cyclic_weights, most: float = 3.0,
        share: float = 1.0, seed: int = 11) -> DataFrame:
    """One row per input row: ``_row`` (the input row), size (words), source_size, target,
    copies (how often the document is taken) and taken (words).

    A document is taken whole or not. Where the budget falls within a document, the next
    ones that still fit are taken instead, for two more rounds, or that document itself
    where this comes nearer to the target. NULL text has no words and is taken
    with the epochs only; NULL is a source like any other; rows equal in id and text have
    equal keys and are taken alike. An empty table gives no rows. The fill of the last
    rounds takes documents for their size as well as their key, so small documents next
    to the budget are taken more often than their weight says; that concerns at most what
    the document on the budget leaves open.
    """
    spark = docs.sparkSession
    text, src = F.col(f"`{text_col}`"), F.col(f"`{source_col}`").cast("string")
    # 1 - u^(1/w) orders documents as the exponential key -ln(u)/w does and lies in (0, 1)
    u = unit_hash(F.col(f"`{id_col}`"), F.coalesce(F.xxhash64(text), F.lit(0)), seed=seed)
    rows = packed(docs, source=F.coalesce(F.concat(F.lit("="), src), F.lit("-")), size=n_words(text),
                  position=1.0 - F.pow(u, 1.0 / quality(text)))
    small = stored(rows.drop("_row"), "mix_sizes")
    totals = small.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals.sort(key=lambda r: r["source"])
    names = [None if r["source"] == "-" else r["source"][1:] for r in totals]
    sizes = [r["size"] for r in totals]
    plan = []
    for r, target in zip(totals, share_out(sizes, weights(names), share * sum(sizes), most)):
        epochs = int(target // r["size"]) if r["size"] else 0
        plan.append((r["source"], r["size"], float(target), epochs, float(target - epochs * r["size"])))
    groups = spark.createDataFrame(plan, "source string, source_size long, target double, epochs long, budget double")
    # each round takes what comes before the document on which the budget falls, and the
    # next one fills what is left with smaller ones further on
    for k in range(ROUNDS):
        if k:
            small = stored(small.join(groups.select("source", "budget", f"hi{k - 1}"), "source")
                           .where(F.col("position") >= F.col(f"hi{k - 1}")).where("size <= budget")
                           .drop("budget", f"hi{k - 1}"), "mix_left")
        found = cuts(small, groups, "source", F.col("position"), F.col("size"), levels=3, label="mix_cuts", few=True).join(
            small.groupBy("source").agg(F.sum("size").alias("all")), "source", "left")
        below = F.when(F.col("cut_lo") < 1, F.col("cut_below")).otherwise(F.coalesce("all", F.lit(0)))
        left = F.col("budget") - below
        groups = stored(found.select(
            *[c for c in groups.columns if c != "budget"], left.alias("budget"),
            F.col("budget").alias(f"gap{k}"), F.col("cut_hi").alias(f"hi{k}"),
            F.when(F.col("budget") > 0, F.col("cut_lo")).otherwise(F.lit(0.0)).alias(f"end{k}"),
            F.when(F.col("cut_in") > left, F.col("cut_in") - left).alias(f"over{k}")), "mix_groups")
    # the round that ends with the document on which the budget falls, where that comes
    # nearer to the budget than all rounds without such a document
    over = [F.col(f"over{k}") for k in range(ROUNDS)]
    last = F.coalesce(*[F.when(o == F.least("budget", *over), k) for k, o in [(ROUNDS, F.col("budget")), *enumerate(over)]])
    groups = groups.withColumn("last", last)
    taken = F.lit(False)
    for k in range(ROUNDS):
        fits = F.col("position") < F.when(F.col("last") == k, F.col(f"hi{k}")).when(
            F.col("last") > k, F.col(f"end{k}")).otherwise(F.lit(0.0))
        if k:
            fits &= F.col("size") <= F.col(f"gap{k}")
            for j in range(k):  # not before where an earlier round ended
                fits &= F.col("position") >= F.col(f"hi{j}")
                if j:
                    fits &= F.col("size") <= F.col(f"gap{j}")
        taken |= fits
    copies = F.col("epochs") + F.when(taken & (F.col("size") > 0), 1).otherwise(0)
    return (rows.join(F.broadcast(groups), "source")  # at most MAX_SOURCES rows
            .select("_row", "size", "source_size", "target", copies.cast("long").alias("copies"),
                    (copies * F.col("size")).cast("long").alias("taken")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the input's columns."""
    return mix(docs, **options).withColumn("_copy", F.explode(F.expr(
        "case when copies > 0 then sequence(1, copies) end"))).select("_row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix(table(spark, sf_dir, "documents"))
            .select("_row.doc_id", "size", "source_size", "target", "taken", "copies"))
