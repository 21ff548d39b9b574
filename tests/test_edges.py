"""Edge cases: empty tables, NULL features, unseen categories at scoring time."""

import pytest
from pyspark.sql import functions as F

from tabulon.operators import features as FE
from tabulon.operators import metrics as M
from tabulon.operators import models as MD
from tabulon.operators import profile as P


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "x double, s string, label int, score double")


def test_profiles_of_an_empty_table(empty):
    assert P.table_shape(empty).first().n_rows == 0
    d = {r.column_name: r for r in P.describe_columns(empty).collect()}
    assert d["x"].n == 0 and d["x"].mean is None
    assert {r.column_name: r.n_missing for r in P.missing_counts(empty).collect()}["x"] == 0
    assert P.histogram(empty, "x").count() == 0
    assert P.kde_density(empty, "x").count() == 0
    assert P.exact_median(empty, "x") is None
    assert P.value_counts(empty, "s").count() == 0


def test_auc_needs_both_classes(spark):
    one_class = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    r = M.auc(one_class).first()
    assert r.n_neg == 0 and r.auc is None


def test_null_numeric_feature_imputed_then_modelled(spark):
    rows = [(float(i % 7) if i % 5 else None, "a" if i % 2 else "b", float(i % 7) * 2.0) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, c string, y double")
    # the assembler refuses NULL by default ...
    with pytest.raises(Exception):
        FE.feature_recipe(["c"], ["x"], assemble_invalid="error").fit(df).transform(df) \
          .select(F.col("features")).collect()
    # ... so impute first (exact median), then fit
    filled = P.impute_median(df, ["x"])
    model = MD.fit_with_recipe(FE.feature_recipe(["c"], ["x"]), MD.forest_regressor(label="y", numTrees=3), filled)
    assert model.transform(filled).where(F.col("prediction").isNull()).count() == 0


def test_unseen_category_scores(spark):
    train = spark.createDataFrame([("a", 1.0, 0), ("b", 2.0, 1)] * 20, "c string, x double, label int")
    model = MD.fit_with_recipe(FE.feature_recipe(["c"], ["x"]), MD.forest_classifier(numTrees=3), train)
    new = spark.createDataFrame([("never-seen", 1.5, 0)], "c string, x double, label int")
    assert model.transform(new).first().prediction in (0.0, 1.0)


def test_index_level_guard(spark):
    df = spark.range(500).selectExpr("cast(id as string) as uid", "cast(id % 2 as double) as y")
    with pytest.raises(ValueError):
        MD.fit_with_recipe(FE.feature_recipe(["uid"], []), MD.forest_regressor(label="y", numTrees=2), df,
                           max_levels=100)
    assert FE.check_levels(df, ["uid"], max_levels=10_000)["uid"] > 400


def test_approximate_median_imputer(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "x double")
    out = P.impute_median(df, ["x"], exact=False).where(F.col("x") == 50.0).count()
    assert out == 2  # the NULL became the median 50


def test_write_table_partitioned(spark, tmp_path):
    from tabulon.sources import write_table
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    path = write_table(df, str(tmp_path / "t"), partition_by=["p"])
    back = spark.read.parquet(path).where(F.col("p") == "a")
    assert back.count() == 1
