"""Exact Shapley values of forests, from the forest's own table of nodes.

A fitted forest is saved and its node table read back; every leaf becomes a path, the
conditions that lead to it, grouped by raw column (the one-hot slots of a category belong
together). For a record x and a background row z, a leaf counts for the game in which a
column's value comes from x or from z, and what it gives each column depends only on two
masks over the path's columns: whose conditions x meets, and whose z meets. So for every
leaf one small table, from x's mask to what each column gets, is computed from the whole
background beforehand, and a record's values are one look-up a leaf: no hybrid rows, no
sampled orders. The values are those of the interventional game, averaged over the
background, and add up to f(x) less the background's mean.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators.features import feature_names
from tabulon.session import shared_path

#: Most raw columns on one path: a leaf's table has two to that power rows.
MAX_ON_PATH = 14
#: Most rows of a background, each a vector on the driver.
MAX_BACKGROUND = 10_000


def node_table(spark: SparkSession, forest: MLWritable) -> DataFrame:
    """The nodes of a fitted random forest: treeID, id, value (of a leaf: the prediction, or
    the share of class 1), n (training rows), left, right (-1 in a leaf), slot, categories
    (-1 where the split is a threshold) and split_values (the threshold, or the categories
    that go left)."""
    path = shared_path(spark, "models", "forest", unique=True)
    forest.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    stats = F.col("impurityStats")
    value = F.col("prediction")
    if hasattr(forest, "numClasses"):
        value = stats[1] / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return nodes.select("treeID", "id", value.alias("value"), F.col("rawCount").alias("n"),
                        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
                        F.col("split.featureIndex").alias("slot"), F.col("split.numCategories").alias("categories"),
                        F.col("split.leftCategoriesOrThreshold").alias("split_values"))


@dataclass
class Paths:
    """All leaves of a forest, tree by tree. ``splits``: the different splits (slot, values, categories).
    A leaf's conditions lie in ``conditions[k]``, a row (leaf, bit, split, goes left), where
    bit is the place of the column among the leaf's ``columns``."""

    trees: int
    tree: np.ndarray
    splits: list[tuple[int, tuple[float, ...], int]]
    value: np.ndarray
    columns: list[list[int]]
    conditions: np.ndarray


def leaf_paths(nodes: DataFrame | list, column_of_slot: Sequence[int] | None = None, min_split: int = 0,
               max_depth: int | None = None) -> Paths:
    """The paths of a node table (or its rows); its size is the model's, which the driver
    holds anyway. Without ``column_of_slot`` all slots count as one column. Nodes of fewer
    than ``min_split`` training rows, or ``max_depth`` splits down, are leaves."""
    trees: dict[int, dict[int, tuple]] = {}
    for r in nodes if isinstance(nodes, list) else nodes.collect():
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    splits: dict[tuple, int] = {}
    value, whose, columns, conditions = [], [], [], []
    column = (lambda slot: 0) if column_of_slot is None else column_of_slot.__getitem__
    for number in sorted(trees):
        tree, todo = trees[number], [(0, ())]
        while todo:
            at, path = todo.pop()
            r = tree[at]
            if r["left"] < 0 or r["n"] < min_split or max_depth is not None and len(path) >= max_depth:
                own = sorted({column(slot) for _, slot, _ in path})
                conditions += [(len(value), own.index(column(slot)), k, left) for k, slot, left in dict.fromkeys(path)]
                value.append(r["value"])
                whose.append(number)
                columns.append(own)
                continue
            k = splits.setdefault((r["slot"], tuple(r["split_values"]), r["categories"]), len(splits))
            todo += [(r["left"], (*path, (k, r["slot"], 1))), (r["right"], (*path, (k, r["slot"], 0)))]
    return Paths(len(trees), np.array(whose, np.int64), list(splits), np.array(value, float), columns,
                 np.array(conditions, np.int64).reshape(-1, 4))


def mask_reader(paths: Paths):
    """A function from vectors (a row each) to masks: for every row and leaf, which of the
    leaf's columns meet all their conditions. It holds arrays only, so tasks need nothing
    else."""
    slots = np.array([s for s, _, _ in paths.splits], np.int64)
    limit = np.array([v[0] if c < 0 else 0.0 for _, v, c in paths.splits])
    sets = [(k, np.array(v)) for k, (_, v, c) in enumerate(paths.splits) if c >= 0]
    leaves = len(paths.value)
    leaf, bit, split, left = paths.conditions.T
    # conditions of one column of a leaf stand together
    order = np.lexsort((split, bit, leaf))
    leaf, bit, split, left = leaf[order], bit[order], split[order], left[order].astype(bool)
    start = np.flatnonzero(np.diff(leaf * 64 + bit, prepend=-1))
    add = np.left_shift(1, bit[start])
    whose = leaf[start]
    first = np.flatnonzero(np.diff(whose, prepend=-1))
    present = whose[first]

    def read(x: np.ndarray) -> np.ndarray:
        goes = x[:, slots] <= limit
        for k, members in sets:
            goes[:, k] = np.isin(x[:, slots[k]], members)
        out = np.zeros((len(x), leaves), np.int64)
        if len(start):
            met = np.logical_and.reduceat(goes[:, split] == left, start, axis=1)
            out[:, present] = np.add.reduceat(np.where(met, add, 0), first, axis=1)
        return out

    return read


def path_tables(paths: Paths, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """For the background's masks: ``shares``, all leaves' tables one below the other (a row
    for each mask of x, an entry for each of the leaf's columns), ``start``, where each
    leaf's begins, and the forest's mean over the background."""
    most = max((len(c) for c in paths.columns), default=0)
    if most > MAX_ON_PATH:
        raise ValueError(f"{most} columns on one path; at most {MAX_ON_PATH}")
    sizes = np.array([1 << len(c) for c in paths.columns], np.int64)
    start = np.concatenate(([0], np.cumsum(sizes)))
    shares = np.zeros((int(start[-1]), max(1, most)))
    weight = np.array([[factorial(max(u - 1, 0)) * factorial(v) / factorial(u + v) if u + v else 0.0
                        for v in range(most + 1)] for u in range(most + 1)])
    ones = np.array([i.bit_count() for i in range(1 << most)], np.int64)
    base = 0.0
    for k, columns in enumerate(paths.columns):
        full = (1 << len(columns)) - 1
        z, times = np.unique(masks[:, k], return_counts=True)
        scale = paths.value[k] / (paths.trees * len(masks))
        base += scale * times[z == full].sum()
        x = np.arange(full + 1)[:, None]
        mine, theirs = x & ~z, z & ~x
        counts = np.where((x | z) == full, times * scale, 0.0)
        u, v = ones[mine], ones[theirs]
        gain, loss = counts * weight[u, v], counts * weight[v, u]
        for b in range(len(columns)):
            shares[start[k]:start[k + 1], b] = (np.where(mine >> b & 1, gain, 0.0) - np.where(theirs >> b & 1, loss, 0.0)).sum(1)
    return shares, start, base


def column_slots(assembled: DataFrame, features: Sequence[str], scaled: Sequence[str], vector_col: str) -> list[int]:
    """For every slot of the vector the place of its raw column in ``features``."""
    out = []
    for name in feature_names(assembled, vector_col, scaled):
        hits = [c for c in features if name == c or name in (f"{c}_index", f"{c}_normalized") or name.startswith(f"{c}_encoded_")]
        if not hits:
            raise ValueError(f"slot {name!r} belongs to none of {list(features)}")
        out.append(features.index(max(hits, key=len)))
    return out


def tree_shapley_wide(model: PipelineModel, rows: DataFrame, id_col: str, features: Sequence[str], background: DataFrame,
                      scaled: Sequence[str] = (), vector_col: str = "features",
                      max_background: int = MAX_BACKGROUND) -> DataFrame:
    """One row per record: id, ``value__<f>`` (text), ``phi__<f>``, base, fx, for a pipeline
    whose last stage is a random forest (of a classifier: the probability of class 1).

    ``background``: at most ``max_background`` rows with the raw ``features``; ``scaled``: the
    columns of the scaled block, in order. Values are exact but for rounding. Rows are
    independent: repeated records repeat, an empty table gives no rows; an empty
    background is refused.
    """
    spark, features = rows.sparkSession, list(features)
    recipe, forest = PipelineModel(model.stages[:-1]), model.stages[-1]
    vector = vector_to_array(F.col(vector_col)).alias("__vector")
    some = [r[0] for r in recipe.transform(background).select(vector).limit(max_background + 1).collect()]
    if not some or len(some) > max_background:
        raise ValueError(f"{len(some) or 'no'} background rows; from 1 to {max_background}")
    assembled = recipe.transform(rows)
    paths = leaf_paths(node_table(spark, forest), column_slots(assembled, features, scaled, vector_col))
    read = mask_reader(paths)
    shares, start, base = path_tables(paths, read(np.array(some, float)))
    full = np.array([(1 << len(c)) - 1 for c in paths.columns], np.int64)
    most = shares.shape[1]
    # column of each entry of a leaf's table; entries that a leaf lacks are 0 and go to column 0
    to = np.zeros((most, len(full), len(features)))
    for k, own in enumerate(paths.columns):
        for b, c in enumerate(own):
            to[b, k, c] = 1.0
    value = paths.value / paths.trees
    shared = spark.sparkContext.broadcast((shares, start[:-1], full, to, value))
    src = assembled.select(F.col(id_col), *[F.col(f"`{c}`").cast("string").alias(f"value__{c}") for c in features], vector)
    kept = src.columns[:-1]
    phis = [f"phi__{c}" for c in features]
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + [f"`{p}` double" for p in phis] + ["base double", "fx double"])

    def run(batches):
        shares, start, full, to, value = shared.value
        together = max(1, 2_000_000 // max(1, len(full)))
        for batch in batches:
            for at in range(0, batch.num_rows, together):
                part = batch.slice(at, together)
                x = np.array(part.column(len(kept)).to_pylist(), float)
                mask = read(x)
                row = start + mask
                phi = sum(shares[row, b] @ to[b] for b in range(len(to)))
                fx = (mask == full) @ value
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(kept)], *[pa.array(np.ascontiguousarray(c)) for c in phi.T],
                     pa.array(np.full(len(x), base)), pa.array(fx)], names=[*kept, *phis, "base", "fx"])

    return src.mapInArrow(run, fields)


def predict_by_paths(paths: Paths, vectors: np.ndarray) -> np.ndarray:
    """The forest's output for each vector, from the paths alone."""
    full = np.array([(1 << len(c)) - 1 for c in paths.columns], np.int64)
    return (mask_reader(paths)(vectors) == full) @ paths.value / paths.trees


def prefix_scores(spark: SparkSession, forest, rows: DataFrame, label_col: str, trees: Sequence[int],
                  min_split: Sequence[int] = (0,), max_depth: Sequence[int | None] = (None,),
                  vector_col: str = "features") -> DataFrame:
    """(setting, label, score): for every row the outputs of the forests of the first n trees,
    for every n of ``trees``, pruned to every ``min_split`` and ``max_depth``; setting is the
    place in itertools.product(max_depth, min_split, trees). One forest gives them all."""
    nodes = node_table(spark, forest).collect()
    variants, places, known = [], [], {}
    for depth in max_depth:
        for least in min_split:
            # bounds that make leaves of the same nodes leave the same trees, which are scored once
            cut = (depth, sum(r["left"] >= 0 and r["n"] < least for r in nodes))
            if cut not in known:
                known[cut] = len(variants)
                paths = leaf_paths(nodes, None, least, depth)
                variants.append((mask_reader(paths), paths.value, np.flatnonzero(np.diff(paths.tree, prepend=-1)),
                                 np.array([len(c) for c in paths.columns], np.int64)))
            places.append(known[cut])
    ends = np.array(trees, np.int64)
    src = rows.select(F.col(label_col).cast("double").alias("label"), vector_to_array(F.col(vector_col)).alias("v"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                x = np.array(part.column(1).to_pylist(), float)
                scores = []
                for read, value, start, full in variants:
                    each = np.add.reduceat(np.where(read(x) == full, value, 0.0), start, axis=1)
                    scores.append(np.cumsum(each, axis=1)[:, ends - 1] / ends)
                scores = np.concatenate([scores[k] for k in places], axis=1)
                n = scores.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(n, dtype=np.int32), len(x))),
                     pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), n)), pa.array(scores.ravel())],
                    names=["setting", "label", "score"])

    return src.mapInArrow(run, "setting int, label double, score double")


def prune_small_nodes(forest, spark: SparkSession, least: int):
    """The same forest in which no node of fewer than ``least`` training rows is split: such a
    node becomes a leaf that predicts as its rows did (scikit-learn's
    ``min_samples_split``). Growing never looks below a node to split it, so this is what
    the forest had been, had it been grown with that bound.

    The saved node table is rewritten, nodes numbered anew in their old order, and
    loaded; a tree's nodes are worked on together (at most 2 ** (depth + 1)).
    """
    path = shared_path(spark, "models", "forest", unique=True)
    forest.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")

    def pruned(tree: pa.Table) -> pa.Table:
        rows = {r["nodeData"]["id"]: r for r in tree.to_pylist()}
        kept, todo = [], [0]
        while todo:
            at = todo.pop()
            node = rows[at]["nodeData"]
            kept.append(at)
            if node["leftChild"] >= 0 and node["rawCount"] >= least:
                todo += [node["rightChild"], node["leftChild"]]
            else:
                node |= {"gain": -1.0, "leftChild": -1, "rightChild": -1,
                         "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        number = {at: k for k, at in enumerate(sorted(kept))} | {-1: -1}
        for at in kept:
            node = rows[at]["nodeData"]
            node |= {"id": number[at], "leftChild": number[node["leftChild"]], "rightChild": number[node["rightChild"]]}
        return pa.Table.from_pylist([rows[at] for at in sorted(kept)], schema=tree.schema)

    out = shared_path(spark, "models", "forest", unique=True)
    forest.write().save(out)
    nodes.groupBy("treeID").applyInArrow(pruned, nodes.schema).write.mode("overwrite").parquet(f"{out}/data")
    return type(forest).load(out)


def part_of_forest(forest, spark: SparkSession, trees: int, max_depth: int):
    """The first ``trees`` trees of a fitted forest, cut ``max_depth`` splits down: a forest of
    that size and depth. Growing a node looks at nothing below it, and trees know nothing of
    each other. As after MLlib's fit, sibling leaves that predict the same are one leaf."""
    path = shared_path(spark, "models", "forest", unique=True)
    forest.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").where(F.col("treeID") < trees)

    def cut(tree: pa.Table) -> pa.Table:
        rows = {r["nodeData"]["id"]: r for r in tree.to_pylist()}
        kept, todo = [], [(0, 0)]
        while todo:
            at, depth = todo.pop()
            kept.append(at)
            node = rows[at]["nodeData"]
            if node["leftChild"] >= 0 and depth < max_depth:
                todo += [(node["rightChild"], depth + 1), (node["leftChild"], depth + 1)]
            else:
                node["leftChild"] = node["rightChild"] = -1
        for at in reversed(kept):  # children before their parents
            node = rows[at]["nodeData"]
            below = [rows[k]["nodeData"] for k in (node["leftChild"], node["rightChild"]) if k >= 0]
            if below and all(b["leftChild"] < 0 for b in below) and below[0]["prediction"] == below[1]["prediction"]:
                node["leftChild"] = node["rightChild"] = -1
            if node["leftChild"] < 0:
                node |= {"gain": -1.0, "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        kept, todo = [], [0]
        while todo:
            at = todo.pop()
            kept.append(at)
            todo += [k for k in (rows[at]["nodeData"]["leftChild"], rows[at]["nodeData"]["rightChild"]) if k >= 0]
        number = {at: k for k, at in enumerate(sorted(kept))} | {-1: -1}
        for at in kept:
            node = rows[at]["nodeData"]
            node |= {"id": number[at], "leftChild": number[node["leftChild"]], "rightChild": number[node["rightChild"]]}
        return pa.Table.from_pylist([rows[at] for at in sorted(kept)], schema=tree.schema)

    out = shared_path(spark, "models", "forest", unique=True)
    nodes.groupBy("treeID").applyInArrow(cut, nodes.schema).write.parquet(f"{out}/data")
    each = spark.read.parquet(f"{path}/treesMetadata")  # the first column is the tree's number
    each.where(F.col(each.columns[0]) < trees).write.parquet(f"{out}/treesMetadata")
    about = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    about["numTrees"] = trees
    about["paramMap"] |= {"numTrees": trees, "maxDepth": max_depth}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{out}/metadata")
    return type(forest).load(out)


def joined_forest(forests: Sequence, spark: SparkSession):
    """One forest of the trees of several that were fitted alike, in their order."""
    nodes = each = None
    out, trees = shared_path(spark, "models", "forest", unique=True), 0
    for forest in forests:
        path = shared_path(spark, "models", "forest", unique=True)
        forest.write().save(path)
        own, about_own = spark.read.parquet(f"{path}/data"), spark.read.parquet(f"{path}/treesMetadata")
        number = about_own.columns[0]  # of a tree
        own = own.withColumn("treeID", (F.col("treeID") + trees).cast(own.schema["treeID"].dataType))
        about_own = about_own.withColumn(number, (F.col(number) + trees).cast(about_own.schema[number].dataType))
        nodes = own if nodes is None else nodes.unionByName(own)
        each = about_own if each is None else each.unionByName(about_own)
        about = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        trees += forest.getNumTrees
    nodes.write.parquet(f"{out}/data")
    each.write.parquet(f"{out}/treesMetadata")
    about["numTrees"] = trees
    about["paramMap"] |= {"numTrees": trees}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{out}/metadata")
    return type(forests[0]).load(out)


def smallest_split(nodes: DataFrame) -> int | None:
    """Training rows of the smallest node that is split; None without any."""
    return nodes.where("left >= 0").agg(F.min("n")).first()[0]
