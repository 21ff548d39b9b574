"""Sharding by a k-d tree over the documents' metadata.

All nodes of a level are split together: a node is cut along the dimension in which its
rows spread widest, at the point where its bytes divide in the proportion of the shards
that each side will hold (the weighted median for an even number). The point is found by
a descent over histograms, so no node is sorted or gathered; rows that lie on it are
divided by a hash of the row. Where a large row lies on the cut, the gap that it leaves is
filled with smaller rows of the other side. Splitting ends when a leaf holds one shard's
bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.llm.common import discard, packed, stored, table, unit_hash
from tabulon.llm.descent import cuts

#: Rows numbered together when a shard's rows get their slots.
ROWS_A_BUCKET = 2000
#: Rounds that fill the gap at a cut, and the share of a node's bytes under which it stays.
ROUNDS, GAP = 2, 0.001


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus one; 1 for NULL."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def dimensions(id_col: str, size: Column, tags: list[str], low: int, high: int) -> list[Column]:
    """Metadata as positions in [0, 1): the id within its range, the size by its logarithm,
    and each tag by its hash; 0 where missing."""
    span = float(max(1, high - low + 1))
    out = [F.coalesce((F.col(f"`{id_col}`") - F.lit(low)) / span, F.lit(0.0)), F.log2(size) / 64.0]
    return out + [F.coalesce(F.crc32(F.col(f"`{t}`").cast("string")) / float(1 << 32), F.lit(0.0)) for t in tags]


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id",
              text_col: str = "text", tag_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per input row: ``_row`` without the text, size, text_crc32, shard, and slot
    (gapless from 0 within the shard).

    Give the number of ``shards``, or ``target_bytes`` for leaves of about that size.
    Shards are numbered in the order of the tree's leaves and have nearly equal bytes.
    NULL text counts one byte and the checksum of the empty text; NULL metadata is the
    least; an empty table gives no rows. The shards follow from the rows alone, however
    they are partitioned; only rows equal in id and text are told apart by their place, and
    may go to different shards.
    """
    text = F.col(f"`{text_col}`")
    low, high = docs.agg(F.min(f"`{id_col}`"), F.max(f"`{id_col}`")).first()
    dims = dimensions(id_col, text_size(text), list(tag_cols), low or 0, high or 0)
    names = [f"d{i}" for i in range(len(dims))]
    slim = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = packed(docs, size=text_size(text), text_crc32=F.crc32(F.coalesce(text, F.lit("")).cast("binary")),
                  row=F.monotonically_increasing_id(), own=F.xxhash64(F.col(f"`{id_col}`"), text), **dict(zip(names, dims)))
    rows = stored(rows.withColumn("_row", F.struct(*[F.col("_row")[c].alias(c) for c in slim.columns])), "kd_read")
    again = stored(rows.groupBy("own").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("own", F.lit(True).alias("again")),
                   "kd_again")
    tie = unit_hash(F.col("own"), seed=5)
    if again.isEmpty():
        rows = rows.withColumn("tie", tie)
    else:
        rows = stored(rows.join(again, "own", "left").withColumn(
            "tie", F.when(F.col("again"), unit_hash(F.col("row"), F.col("own"), seed=5)).otherwise(tie)), "kd_rows")
    n, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    if shards is None:
        shards = max(1, math.ceil((total or 0) / target_bytes))
    tree = stored(rows.select("row", "size", "tie", *names, F.lit(0).alias("node"), F.lit(shards).alias("holds")),
                  "kd_level")
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        tree = _split(tree, names, shards <= 100_000)
    placed = rows.join(tree.select("row", F.col("node").alias("shard")), "row")
    return _slots(placed, n).select("_row", "size", "text_crc32", "shard", "slot")


def _split(tree: DataFrame, names: list[str], few: bool) -> DataFrame:
    """Split every node that still holds more than one shard; nodes are named by the first
    shard that they hold. ``few``: so few shards, and nodes, that they may be broadcast."""
    spread = F.greatest(*[F.struct((F.max(d) - F.min(d)).alias("width"), F.lit(-i).alias("dim"))
                          for i, d in enumerate(names)])
    nodes = stored(tree.where("holds > 1").groupBy("node", "holds")
                   .agg(F.sum("size").alias("bytes"), spread.alias("wide"))
                   .select("node", "holds", (-F.col("wide.dim")).alias("dim"),
                           F.floor(F.col("holds") / 2).cast("int").alias("left"),
                           (F.col("bytes") * F.floor(F.col("holds") / 2) / F.col("holds")).alias("budget")), "kd_nodes")
    along = F.element_at(F.array(*names), F.col("dim") + 1)
    inner = tree.join(nodes.select("node", "dim"), "node").withColumn("at", along)
    first = cuts(inner, nodes, "node", F.col("at"), F.col("size"), levels=2, label="kd_cuts", few=few)
    edge = stored(first.select("node", "cut_lo", "cut_hi", (F.col("budget") - F.col("cut_below")).alias("budget")), "kd_edge")
    tied = (inner.select("node", "at", "size", "tie").join(edge.select("node", "cut_lo", "cut_hi"), "node")
            .where("at >= cut_lo and at < cut_hi"))
    second = cuts(tied, edge.select("node", "budget"), "node", F.col("tie"), F.col("size"), levels=2,
                  label="kd_ties", few=few)
    # rows up to the cut leave a gap of less than the row that lies on it
    ends = second.select("node", F.when(F.col("cut_lo") < 1, F.col("cut_lo")).otherwise(F.lit(2.0)).alias("tie_cut"),
                         F.when(F.col("cut_lo") < 1, F.col("budget") - F.col("cut_below")).otherwise(F.lit(0.0)).alias("gap0"))
    limits = stored(nodes.select("node", "dim", "left", "budget").join(edge.select("node", "cut_lo", "cut_hi"), "node")
                    .join(ends, "node"), "kd_limits")
    before = (along < F.col("cut_lo")) | ((along < F.col("cut_hi")) & (F.col("tie") < F.col("tie_cut")))
    rounds = 0
    while rounds < ROUNDS and not limits.where(F.col(f"gap{rounds}") > GAP * F.col("budget")).isEmpty():
        gap = F.col(f"gap{rounds}")
        start = F.col(f"end{rounds - 1}") if rounds else F.lit(0.0)
        rest = (tree.join(F.broadcast(limits) if few else limits, "node").where(~before & (F.col("size") <= gap) & (F.col("tie") >= start))
                .select("node", "tie", "size"))
        found = cuts(rest, limits.select("node", gap.alias("budget")), "node", F.col("tie"), F.col("size"), levels=2, label="kd_fill", few=few)
        last = limits
        all_ = rest.groupBy("node").agg(F.sum("size").alias("all"))
        limits = stored(limits.join(found.select("node", "cut_lo", "cut_below").withColumnsRenamed(
            {"cut_lo": f"end{rounds}", "cut_below": "below"}), "node").join(all_, "node", "left").withColumn(
            f"gap{rounds + 1}", gap - F.when(F.col(f"end{rounds}") < 1, F.col("below")).otherwise(F.coalesce("all", F.lit(0))))
            .drop("below", "all"), "kd_limits")
        discard(last)
        rounds += 1
    left = before
    for k in range(rounds):
        taken = (F.col("size") <= F.col(f"gap{k}")) & (F.col("tie") < F.col(f"end{k}"))
        left = left | (taken & (F.col("tie") >= F.col(f"end{k - 1}")) if k else taken)
    moved = tree.join(F.broadcast(limits) if few else limits, "node", "left")
    left = F.coalesce(left, F.lit(True))
    out = stored(moved.select(
        "row", "size", "tie", *names,
        F.when(F.col("left").isNull() | left, F.col("node")).otherwise(F.col("node") + F.col("left")).alias("node"),
        F.when(F.col("left").isNull(), F.col("holds")).when(left, F.col("left"))
        .otherwise(F.col("holds") - F.col("left")).cast("int").alias("holds")), "kd_level")
    discard(tree, nodes, edge, limits)
    return out


def _slots(placed: DataFrame, n: int) -> DataFrame:
    """Number the rows of each shard: buckets of a few rows are numbered on their own, and
    start where the buckets before them end."""
    buckets = 1 + n // ROWS_A_BUCKET
    rows = placed.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    run = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select("shard", "bucket", F.coalesce(F.sum("rows").over(run), F.lit(0)).alias("start")),
                    "kd_starts")
    own = Window.partitionBy("shard", "bucket").orderBy("row")
    return (rows.withColumn("own", F.row_number().over(own) - 1).join(starts, ["shard", "bucket"])
            .withColumn("slot", (F.col("start") + F.col("own")).cast("long")))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (kd_shards(table(spark, sf_dir, "documents"), shards=16)
            .select("_row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                    "slot", F.lit(None).cast("int").alias("grown_shard")))
