"""Forests, save/load, scoring, tuning, Shapley and streaming on the sf0.001 tables."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabulon.catalog import modeling as MO
from tabulon.operators import explain as X
from tabulon.operators import models as MD
from tabulon.operators import tuning as TU
from tabulon.operators.score import score_claims, score_fraud
from tabulon.session import shared_path
from tabulon.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def split(spark):
    return MO.claims_split(spark, SF_SMALL)


@pytest.fixture(scope="module")
def reg_model(split):
    train, _ = split
    return MO.regression_model(train, numTrees=5)


def test_forest_regression_in_label_range(split, reg_model):
    train, test = split
    lo, hi = train.agg(F.min("net_amount"), F.max("net_amount")).first()
    preds = [r.prediction for r in reg_model.transform(test).select("prediction").collect()]
    assert len(preds) == test.count() and all(lo - 1e-6 <= p <= hi + 1e-6 for p in preds)


def test_save_load_same_predictions(spark, split, reg_model):
    _, test = split
    path = save_model(reg_model, shared_path(spark, "test-models", unique=True))
    save_model(reg_model, path)  # overwrite works
    again = load_model(path)
    a = [r.prediction for r in reg_model.transform(test).orderBy(*MO.LINE_KEY).collect()]
    b = [r.prediction for r in again.transform(test).orderBy(*MO.LINE_KEY).collect()]
    assert a == b


def test_score_claims_flags(split, reg_model):
    _, test = split
    rows = score_claims(reg_model, test, "net_amount", MO.LINE_KEY).collect()
    assert rows and all(
        (r.Claim_Status == "Abnormal Claim") == (r.Expected_Expenses < r.Actual_Expenses) for r in rows)
    assert set(rows[0].asDict()) == set(MO.LINE_KEY) | {"Expected_Expenses", "Actual_Expenses", "Claim_Status"}


def test_classifier_probability_and_text(split):
    train, test = split
    model = MO.classification_model(train, numTrees=5)
    pred = model.transform(MO.with_label(test)).select(MD.positive_probability().alias("p"), "prediction")
    assert all(0.0 <= r.p <= 1.0 and r.prediction in (0.0, 1.0) for r in pred.collect())
    text = score_fraud(model, test.drop("fraud_reported"), MO.LINE_KEY)
    assert {r["Model Prediction"] for r in text.collect()} <= {"Normal Policy", "Abnormal Policy"}


def test_grid_search_table(spark, split):
    data = MO._train_folds(spark, SF_SMALL, 4)
    trials = TU.cross_validate(MD.forest_classifier(), {"numTrees": [3, 5], "maxDepth": [2, 3]},
                               MO._auc_evaluator(), data, 4, recipe=MO._cls_recipe(), parallelism=2)
    assert all(len(t.scores["score"]) == 4 for t in trials)
    res = TU.results_table(spark, trials, top=3).collect()
    assert len(res) == 3 and res[0].rank_test_score == 1
    assert res[0].mean_test_score >= res[-1].mean_test_score
    curve = TU.validation_curve(MD.forest_classifier(), "maxDepth", [2, 4], MO._auc_evaluator(), data, 4,
                                recipe=MO._cls_recipe())
    assert [r.param_value for r in curve.collect()] == [2.0, 4.0]


def test_recipe_is_fitted_in_each_fold(spark):
    """A value far out in one fold must not scale the rows of the fold that validates it."""
    from pyspark.ml import Pipeline

    df = spark.createDataFrame([(i % 5, float(i % 2), float(i), "x") for i in range(50)] + [(4, 1.0, 1e6, "x")],
                               "fold int, label double, v double, c string")
    from tabulon.operators import features as FE
    sides = list(TU.fold_sides(df, 5, recipe=FE.feature_recipe(["c"], ["v"])))
    top = [max(r.features.toArray().max() for r in valid.collect()) for _, valid in sides]
    assert isinstance(FE.feature_recipe(["c"], ["v"]), Pipeline)
    assert top[4] > 1000 and max(top[:4]) <= 1.0  # scaled by the other folds only


def test_shapley_additivity(spark, split, reg_model):
    train, test = split
    rows = test.limit(20).withColumn("row_id", F.concat_ws("|", *[F.col(c).cast("string") for c in MO.LINE_KEY]))
    bg = X.background_sample(train, MO.REG_FEATURES, 5)
    assert sorted(r.bg_idx for r in bg.collect()) == [0, 1, 2, 3, 4]
    contrib = X.shapley_contributions(reg_model, rows, "row_id", MO.REG_FEATURES, bg, permutations=3)
    add = X.additivity(contrib, "row_id").collect()
    assert len(add) == 20 and all(r.additive for r in add)
    per_row = contrib.groupBy("row_id").count().collect()
    assert {r["count"] for r in per_row} == {len(MO.REG_FEATURES)}
    top = X.shapley_summary(contrib, top=3).collect()
    assert len(top) == 3 and top[0].mean_abs_phi >= top[-1].mean_abs_phi


def test_streaming_scoring(spark, split, reg_model):
    from tabulon.streaming import score_claims_stream, start_claims_scoring
    _, test = split
    src = tempfile.mkdtemp(prefix="tabulon-stream-src-")
    out = tempfile.mkdtemp(prefix="tabulon-stream-out-")
    batch = test.drop("fraud_reported")
    batch.limit(50).write.mode("append").parquet(src)
    stream = score_claims_stream(spark, reg_model, src, batch.schema, "net_amount", MO.LINE_KEY)
    q = start_claims_scoring(stream, out)
    q.processAllAvailable()
    q.stop()
    res = spark.read.parquet(out)
    assert res.count() == 50 and set(res.columns) >= {"Claim_Status", "Expected_Expenses"}
    batch.limit(80).exceptAll(batch.limit(50)).limit(30).write.mode("append").parquet(src)
    again = score_claims_stream(spark, reg_model, src, batch.schema, "net_amount", MO.LINE_KEY)
    q = start_claims_scoring(again, out)  # a restart with the same output goes on
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(out).count() == 80


def test_equal_ids_are_explained_apart(spark, split, reg_model):
    train, test = split
    rows = test.limit(3).withColumn("row_id", F.lit("same"))
    rows = rows.unionByName(rows)
    bg = X.background_sample(train, MO.REG_FEATURES, 4, MO.RECORD_ID)
    wide = X.shapley_wide(reg_model, rows, "row_id", MO.REG_FEATURES, bg, permutations=2).collect()
    one = X.shapley_wide(reg_model, test.limit(3).withColumn("row_id", F.lit("a")), "row_id", MO.REG_FEATURES, bg,
                         permutations=2).collect()
    assert len(wide) == 6 and len({round(r.base, 6) for r in wide + one}) == 1
    assert sorted(round(r.fx, 4) for r in wide) == sorted(2 * [round(r.fx, 4) for r in one])
