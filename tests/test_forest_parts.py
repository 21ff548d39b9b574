"""Forests taken from a larger one, and fits that read their prepared rows once."""
import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabulon.operators import models as MD
from tabulon.operators import trees as T
from tabulon.operators import tuning as TU


@pytest.fixture(scope="module")
def points(spark):
    raw = spark.range(600).select((F.col("id") * 37 % 101).cast("double").alias("a"), (F.col("id") * 53 % 89).cast("double").alias("b"),
                                  (F.col("id") % 3).cast("int").alias("fold"))
    raw = raw.withColumn("label", ((F.col("a") + F.col("b") > 95) | (F.col("a") % 7 == 0)).cast("double"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(raw).coalesce(1)


def by_hand(nodes, vector, depth):
    """Leaf values (by tree) of the trees of a node table, walked ``depth`` splits down."""
    out = []
    for tree in sorted({r["treeID"] for r in nodes}):
        rows, at, d = {r["id"]: r for r in nodes if r["treeID"] == tree}, 0, 0
        while rows[at]["left"] >= 0 and d < depth:
            r = rows[at]
            at, d = (r["left"] if vector[r["slot"]] <= r["split_values"][0] else r["right"]), d + 1
        out.append(rows[at]["value"])
    return out


def test_part_of_a_regression_forest(spark, points):
    whole = MD.forest_regressor(numTrees=5, maxDepth=4, minInstancesPerNode=2).fit(points)
    part = T.part_of_forest(whole, spark, 3, 2)
    assert part.getNumTrees == 3 and part.totalNumNodes < whole.totalNumNodes
    assert max(t.depth for t in part.trees) == 2
    nodes = T.node_table(spark, whole).collect()
    for r in part.transform(points).limit(60).collect():
        assert r["prediction"] == pytest.approx(np.mean(by_hand(nodes, r["features"], 2)[:3]))


def test_part_of_a_classifier_is_as_if_grown_so(spark, points):
    """One tree on all columns and rows has no chance in it: the parts are MLlib's own fits,
    siblings of one prediction merged as there."""
    tree = dict(numTrees=1, featureSubsetStrategy="all", bootstrap=False, minInstancesPerNode=1)
    whole = MD.forest_classifier(maxDepth=5, **tree).fit(points)
    for depth in (1, 3):
        want = MD.forest_classifier(maxDepth=depth, **tree).fit(points)
        got = T.part_of_forest(whole, spark, 1, depth)
        assert got.totalNumNodes == want.totalNumNodes
        both = want.transform(points).select("features", F.col("probability").alias("p"))
        assert got.transform(both).where("p <> probability").count() == 0


def test_settings_of_size_and_depth_share_a_fit(spark, points, monkeypatch):
    fits = []
    estimator = MD.forest_classifier(numTrees=4)
    fit = type(estimator).fit
    monkeypatch.setattr(type(estimator), "fit", lambda self, df, params=None: fits.append(params) or fit(self, df, params))
    grid = {"maxDepth": [1, 3], "numTrees": [2, 4], "minInstancesPerNode": [1, 5]}
    auc = BinaryClassificationEvaluator(labelCol="label", numBins=0)
    trials = TU.cross_validate(estimator, grid, auc, points, 3)
    assert len(fits) == 3 * 2
    assert len(trials) == 8 and all(len(t.scores["score"]) == 3 for t in trials)
    assert len({tuple(sorted(t.params.items())) for t in trials}) == 8
    assert all(0.5 < t.mean("score") <= 1 for t in trials)


def test_fits_leave_nothing_kept(spark, points):
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = MD.fit_prepared([], MD.forest_classifier(numTrees=2), points)
    TU.cross_validate(MD.forest_classifier(numTrees=2), {}, BinaryClassificationEvaluator(labelCol="label"), points, 3)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    assert model.stages[-1].getNumTrees == 2


def test_a_forest_fitted_in_parts(spark, points):
    estimator = MD.forest_regressor(numTrees=5, maxDepth=3, minInstancesPerNode=2)
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    whole = MD.fit_forest(estimator, points, trees_a_fit=2)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    assert whole.getNumTrees == 5 and len(whole.trees) == 5
    nodes = T.node_table(spark, whole).collect()
    trees = [tuple(tuple(r)[1:] for r in sorted(nodes, key=lambda r: r["id"]) if r["treeID"] == k) for k in range(5)]
    assert len(set(map(str, trees))) == 5  # each part draws its own rows
    for r in whole.transform(points).limit(60).collect():
        assert r["prediction"] == pytest.approx(np.mean(by_hand(nodes, r["features"], 3)))


def test_many_trees_are_fitted_in_parts(spark, points, monkeypatch):
    sizes = []
    estimator = MD.forest_regressor(numTrees=5, maxDepth=1)
    fit = type(estimator).fit

    def counted(self, df, params=None):
        sizes.append({p.name: v for p, v in (params or {}).items()}.get("numTrees"))
        return fit(self, df, params)

    monkeypatch.setattr(type(estimator), "fit", counted)
    monkeypatch.setattr(MD.fit_forest, "__defaults__", (2,))
    assert MD.fit_prepared([], estimator, points).stages[-1].getNumTrees == 5
    assert sizes == [1, 2, 2]


def test_grid_keeps_node_ids(spark, points, monkeypatch):
    """Kept node ids give the same trees; bounds that cut nothing are scored once."""
    estimator = MD.forest_classifier(numTrees=4)
    fit, seen, read, reads = type(estimator).fit, [], T.mask_reader, []
    monkeypatch.setattr(type(estimator), "fit", lambda self, df, params=None: seen.append(
        {p.name: v for p, v in params.items()}.get("cacheNodeIds")) or fit(self, df, params))
    monkeypatch.setattr(T, "mask_reader", lambda paths: reads.append(paths) or read(paths))
    trials = TU.forest_grid(estimator, points, 3, [2, 4], min_leaf=[9], min_split=[2, 3, 18])
    assert seen == [True] * 3 and len(reads) == 3
    assert len(trials) == 6 and all(len(t.scores["score"]) == 3 for t in trials)
    own = {k: T.node_table(spark, fit(estimator, points, {estimator.cacheNodeIds: k})).orderBy("treeID", "id").collect()
           for k in (True, False)}
    assert own[True] == own[False]
