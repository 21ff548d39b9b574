"""Feature stages, splits and metrics against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabulon.operators import features as FE
from tabulon.operators import metrics as M
from tabulon.operators.split import hash_split, with_folds
from tabulon.sources.export import features_to_columns


@pytest.fixture(scope="module")
def cats(spark):
    rows = [("b",)] * 3 + [("a",)] * 3 + [("c",)] * 5 + [("d",)]
    return spark.createDataFrame(rows, "v string")


def test_string_indexer_frequency_then_alphabetical(cats):
    m = FE.index_stage(["v"]).fit(cats)
    got = {r.v: r.v_index for r in m.transform(cats).distinct().collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0, "d": 3.0}


def test_keep_maps_unseen_and_null_to_num_labels(spark, cats):
    m = FE.index_stage(["v"], handle_invalid="keep").fit(cats)
    new = spark.createDataFrame([("zz",), (None,), ("c",)], "v string")
    assert [r.v_index for r in m.transform(new).collect()] == [4.0, 4.0, 0.0]


def test_one_hot_drops_last(cats):
    p = Pipeline(stages=[FE.index_stage(["v"]), FE.one_hot_stage(["v"])]).fit(cats)
    out = features_to_columns(p.transform(cats), "v_encoded", 3, keep=["v"]).distinct().collect()
    got = {r.v: (r.f_0, r.f_1, r.f_2) for r in out}
    assert got["c"] == (1.0, 0.0, 0.0) and got["d"] == (0.0, 0.0, 0.0)


def test_dummies_full_and_drop_first(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "s string, k int")
    full = FE.dummies(df, ["s"])
    assert full.columns == ["k", "s_x", "s_y"]
    assert [(r.s_x, r.s_y) for r in full.orderBy("k").collect()] == [(1, 0), (0, 1), (0, 0)]
    assert FE.dummies(df, ["s"], drop_first=True).columns == ["k", "s_y"]
    with pytest.raises(ValueError):
        FE.dummies(df, ["s"], max_levels=1)


def test_min_max_constant_and_unseen_range(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    m = Pipeline(stages=FE.scale_stages(["a", "b"])).fit(train)
    new = spark.createDataFrame([(2.0, 5.0), (5.0, 7.0)], "a double, b double")
    out = features_to_columns(m.transform(new), "numeric_scaled", 2).collect()
    assert [(r.f_0, r.f_1) for r in out] == [(0.5, 0.5), (2.0, 0.5)]  # not clipped; constant -> 0.5


def test_recipe_handles_unseen_category(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "c string, x double")
    model = FE.feature_recipe(["c"], ["x"]).fit(train)
    new = spark.createDataFrame([("zz", 2.0)], "c string, x double")
    vec = model.transform(new).first().features.toArray().tolist()
    assert vec == [0.0, 0.0, 0.5]  # both known labels keep a slot; unseen is all-zero
    assert FE.feature_names(model.transform(new)) == ["c_encoded_a", "c_encoded_b", "numeric_scaled_0"]


def test_hash_split_is_partitioning_independent(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a_train, a_test = hash_split(df, ["k"], seed=123)
    b_train, _ = hash_split(df.repartition(7), ["k"], seed=123)
    ta = {r.k for r in a_train.collect()}
    assert ta == {r.k for r in b_train.collect()}
    assert len(ta) + a_test.count() == 2000 and 0.75 < len(ta) / 2000 < 0.85
    folds = {r.fold for r in with_folds(df, ["k"], 3).collect()}
    assert folds == {0, 1, 2}


def _pairwise_auc(y, p):
    pos = [s for t, s in zip(y, p) if t == 1]
    neg = [s for t, s in zip(y, p) if t == 0]
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def test_auc_exact_with_ties(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    p = np.round(rng.random(400) * 0.7 + 0.3 * y, 1)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "label int, score double")
    r = M.auc(df).first()
    assert r.auc == pytest.approx(_pairwise_auc(y, p), abs=1e-6)
    assert (r.n_pos, r.n_neg) == (int(y.sum()), int((1 - y).sum()))


def test_regression_metrics(spark):
    y = np.array([3.0, 5.0, 2.5, 7.0])
    p = np.array([2.5, 5.0, 4.0, 8.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "label double, prediction double")
    r = M.regression_metrics(df).first()
    mse = round(float(np.mean((y - p) ** 2)), 2)
    assert r.mse == mse and r.rmse == round(mse ** 0.5, 2)
    assert r.r2 == round(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), 4)


def test_confusion_metrics(spark):
    y = [1, 1, 1, 0, 0, 0, 1, 0]
    p = [1, 0, 1, 0, 1, 0, 1, 0]
    df = spark.createDataFrame(list(zip(y, p)), "label int, prediction int")
    r = M.confusion_metrics(df).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (3, 1, 3, 1)
    assert r.accuracy == 0.75 and r.precision == 0.75 and r.recall == 0.75 and r.f1 == 0.75
    assert r.kappa == 0.5 and r.mcc == 0.5


def test_fused_recipe_equals_per_column_stages(spark):
    """5 multi-column stages give the same vector as one indexer, encoder, assembler
    and scaler per column (the reference's 73-stage layout, here for 2 + 3 columns)."""
    from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
    rng = np.random.default_rng(9)
    rows = [(str(rng.choice(["a", "b", "c"])), str(rng.choice(["x", "y"])), float(rng.normal()),
             float(rng.integers(0, 5)), 7.0) for _ in range(300)]
    df = spark.createDataFrame(rows, "c1 string, c2 string, n1 double, n2 double, n3 double")
    cat, num = ["c1", "c2"], ["n1", "n2", "n3"]
    stages = ([StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c in cat]
              + [OneHotEncoder(inputCol=f"{c}_i", outputCol=f"{c}_e") for c in cat]
              + [VectorAssembler(inputCols=[c], outputCol=f"{c}_v") for c in num]
              + [MinMaxScaler(inputCol=f"{c}_v", outputCol=f"{c}_s") for c in num]
              + [VectorAssembler(inputCols=[f"{c}_e" for c in cat] + [f"{c}_s" for c in num],
                                 outputCol="features")])
    per_col = Pipeline(stages=stages).fit(df).transform(df).select("features").collect()
    fused = FE.feature_recipe(cat, num).fit(df).transform(df).select("features").collect()
    assert [r.features.toArray().tolist() for r in per_col] == [r.features.toArray().tolist() for r in fused]


def test_preview_pandas(spark):
    from tabulon.sources.export import preview_pandas
    pdf = preview_pandas(spark.range(100), 7)
    assert len(pdf) == 7


def test_auc_ignores_missing(spark):
    rows = [(1, 0.9), (0, 0.1), (1, None), (None, 0.5), (0, float("nan")), (1, 0.4), (0, 0.4)]
    df = spark.createDataFrame(rows, "label int, score double")
    r = M.auc(df).first()
    assert (r.n_pos, r.n_neg) == (2, 2)
    assert r.auc == pytest.approx(_pairwise_auc([1, 0, 1, 0], [0.9, 0.1, 0.4, 0.4]), abs=1e-9)


def test_metrics_with_missing_values_and_more_classes(spark):
    from tabulon.operators import metrics as M

    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0), (5.0, None), (None, 1.0)], "label double, prediction double")
    r = M.regression_metrics(df).first()
    assert (r.n, r.mse) == (2, 1.0)
    df = spark.createDataFrame([(1, 1), (0, 0), (2, 1), (2, 2), (None, 1)], "label int, prediction int")
    r = M.confusion_metrics(df).first()
    assert (r.tp, r.fp, r.tn, r.fn, r.accuracy) == (1, 1, 2, 0, 0.75)


def test_split_follows_small_fractions(spark):
    df = spark.range(200_000).withColumnRenamed("id", "k")
    train, test = hash_split(df, ["k"], train_fraction=0.995)
    assert 700 < test.count() < 1300
