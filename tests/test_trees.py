"""Exact forest attributions against all orders, and pruned forests."""

import itertools
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabulon.catalog import modeling as C
from tabulon.operators import models as MD
from tabulon.operators import trees as T
from tabulon.operators import tuning


@pytest.fixture(scope="module")
def sides(spark):
    train, test = C.claims_split(spark, SF_SMALL)
    return train.cache(), test.cache()


def brute(model, x, z, features, output):
    """Shapley values by all subsets, of f over raw rows in which some columns come from x."""
    spark, n = x.sparkSession, len(features)
    xs, zs = x.select(*features).collect(), z.select(*features).collect()
    rows = [(i, j, mask, *[(a if mask >> k & 1 else b)[k] for k in range(n)])
            for i, a in enumerate(xs) for j, b in enumerate(zs) for mask in range(1 << n)]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.select(*features).schema.fields)
    scored = model.transform(spark.createDataFrame(rows, f"i int, j int, mask int, {types}"))
    f = {}
    for r in scored.select("i", "mask", output.alias("f")).groupBy("i", "mask").agg(F.avg("f").alias("f")).collect():
        f[r["i"], r["mask"]] = r["f"]
    out = []
    for i in range(len(xs)):
        phi = []
        for k in range(n):
            total = 0.0
            for size in range(n):
                for s in itertools.combinations([c for c in range(n) if c != k], size):
                    mask = sum(1 << c for c in s)
                    total += factorial(size) * factorial(n - size - 1) / factorial(n) * (f[i, mask | 1 << k] - f[i, mask])
            phi.append(total)
        out.append((f[i, 0], f[i, (1 << n) - 1], phi))
    return out


@pytest.mark.parametrize("kind", ["regression", "classification"])
def test_exact_values_are_those_of_all_orders(spark, sides, kind):
    train, test = sides
    x, z = test.orderBy(*C.RECORD_ID).limit(6), train.orderBy(*C.RECORD_ID).limit(9)
    if kind == "regression":
        model, features, scaled, out = C.regression_model(train, numTrees=3, maxDepth=4), C.REG_FEATURES, C.REG_SCALED, F.col("prediction")
    else:
        model, features, scaled, out = (C.classification_model(train, numTrees=4, maxDepth=4), C.CLS_CAT + C.CLS_NUM, C.CLS_NUM,
                                        MD.positive_probability())
    x, z = (spark.createDataFrame(d.collect(), d.schema) for d in (x, z))
    got = T.tree_shapley_wide(model, C._with_row_id(x), "row_id", features, z, scaled).collect()
    want = brute(model, x, z, features, out)
    for r, (base, fx, phi) in zip(got, want):
        size = max(1.0, abs(fx))
        assert abs(r["base"] - base) < 1e-9 * size and abs(r["fx"] - fx) < 1e-9 * size
        assert np.allclose([r[f"phi__{c}"] for c in features], phi, atol=1e-9 * size)
    assert T.tree_shapley_wide(model, C._with_row_id(x.limit(0)), "row_id", features, z, scaled).count() == 0
    with pytest.raises(ValueError):
        T.tree_shapley_wide(model, C._with_row_id(x), "row_id", features, z.limit(0), scaled)


def test_paths_predict_as_the_forest(spark, sides):
    train, test = sides
    model = C.regression_model(train, numTrees=5, maxDepth=6)
    scored = model.transform(test).select(vector_to_array("features").alias("v"), "prediction").collect()
    names = T.column_slots(model.transform(test), C.REG_FEATURES, C.REG_SCALED, "features")
    paths = T.leaf_paths(T.node_table(spark, model.stages[-1]), names)
    got = T.predict_by_paths(paths, np.array([r["v"] for r in scored]))
    assert np.allclose(got, [r["prediction"] for r in scored])


def test_pruned_forest(spark, sides):
    """No split below the bound; every record is predicted by the first small node on its way."""
    train, test = sides
    model = C.regression_model(train, numTrees=4, maxDepth=9, minInstancesPerNode=1)
    whole = T.node_table(spark, model.stages[-1])
    assert T.smallest_split(whole) < 40
    cut = T.prune_small_nodes(model.stages[-1], spark, 40)
    assert T.smallest_split(T.node_table(spark, cut)) >= 40 and cut.getNumTrees == 4
    trees = {}
    for r in whole.collect():
        trees.setdefault(r["treeID"], {})[r["id"]] = r

    def walk(v):
        total = 0.0
        for t in trees.values():
            r = t[0]
            while r["left"] >= 0 and r["n"] >= 40:
                left = v[r["slot"]] in r["split_values"] if r["categories"] >= 0 else v[r["slot"]] <= r["split_values"][0]
                r = t[r["left"] if left else r["right"]]
            total += r["value"]
        return total / len(trees)

    rows = cut.transform(model.transform(test).drop("prediction")).select(vector_to_array("features").alias("v"), "prediction").limit(200)
    for r in rows.collect():
        assert abs(r["prediction"] - walk(r["v"])) < 1e-6 * abs(r["prediction"])


def test_prefix_scores_and_forest_grid(spark, sides):
    """All trees give the model's own probability; the grid's scores are MLlib's on the same folds."""
    from tabulon.operators import tuning as TU
    from tabulon.operators.split import with_folds

    train, test = sides
    model = C.classification_model(train, numTrees=6)
    scored = model.transform(C.with_label(test))
    got = T.prefix_scores(spark, model.stages[-1], scored, "label", [2, 6]).where("setting = 1")
    want = sorted(r["p"] for r in scored.select(MD.positive_probability().alias("p")).collect())
    assert np.allclose(sorted(r["score"] for r in got.collect()), want)
    data = with_folds(C.with_label(train), C.LINE_KEY, 2).cache()
    est = MD.forest_classifier(maxDepth=3)
    trials = TU.forest_grid(est, data, 2, trees=[3, 5], min_split=[2, 10 ** 9], recipe=C._cls_recipe())
    assert len(trials) == 4 and all(len(t.scores["score"]) == 2 for t in trials)
    for t in trials:
        if t.params["min_samples_split"] == 10 ** 9:  # nothing is split: one score for all rows
            assert t.scores["score"] == [0.5, 0.5]
    plain = TU.cross_validate(est, {"numTrees": [5], "minInstancesPerNode": [1]}, C._auc_evaluator(), data, 2, recipe=C._cls_recipe())
    five = next(t for t in trials if t.params["n_estimators"] == 5 and t.params["min_samples_split"] == 2)
    assert np.allclose(plain[0].scores["score"], five.scores["score"], atol=2e-3)
    r2 = TU.forest_grid(MD.forest_regressor(label="net_amount"), data, 2, trees=[2, 4], max_depth=[1, 4], metric="r2",
                        label="net_amount", recipe=C._reg_recipe())
    by = {(t.params["n_estimators"], t.params["max_depth"]): t.mean("score") for t in r2}
    assert len(by) == 4 and by[4, 4] > by[4, 1] + 0.1


def test_kappa_and_mcc_as_evaluators(spark):
    from tabulon.operators.metrics import ConfusionEvaluator

    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, prediction int")
    assert ConfusionEvaluator("kappa").evaluate(df) == 0.5
    assert ConfusionEvaluator("mcc").copy().evaluate(df) == pytest.approx(0.57735, abs=1e-5)
    assert ConfusionEvaluator("mcc").evaluate(df.withColumn("prediction", F.lit(0))) == 0.0


def test_folds_without_a_score_are_left_out(spark):
    trial = tuning.Trial({}, {"score": [0.5, float("nan"), 1.0]})
    assert trial.mean("score") == 0.75 and trial.std("score") == 0.25
    assert np.isnan(tuning.Trial({}, {"score": [float("nan")]}).mean("score"))
    trials = [tuning.Trial({"a": i}, {"score": s}) for i, s in enumerate([[float("nan")], [0.5, float("nan")], [0.75]])]
    assert tuning.best_params(trials) == {"a": 2} and tuning.best_params(trials, False) == {"a": 1}
    got = [(r["params"], r["mean_test_score"]) for r in tuning.results_table(spark, trials).collect()]
    assert got == [('{"a": 2}', 0.75), ('{"a": 1}', 0.5), ('{"a": 0}', None)]
