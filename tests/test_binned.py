"""Forests grown from counted bins, and recipes fitted from summaries."""
import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabulon.operators import binned as B
from tabulon.operators import features as FE
from tabulon.operators import models as MD
from tabulon.operators import recipes as R
from tabulon.operators import trees as T


@pytest.fixture(autouse=True)
def of_any_size(monkeypatch):
    monkeypatch.setattr(B, "LEAST_ROWS", 0)


def raw_rows(spark, n=400):
    i = F.col("id")
    return spark.range(n).select(
        i, F.element_at(F.array(*map(F.lit, "aabc")), ((i % 4) + 1).cast("int")).alias("c"), (i * 37 % 101).cast("double").alias("v"),
        (i * 53 % 89).alias("w"), (i % 5).cast("int").alias("fold"), (((i * 37 % 101) + (i * 53 % 89)) > 95).cast("double").alias("label"))


def recipe():
    return FE.feature_recipe(["c"], ["v", "w"])


def points(spark):
    raw = raw_rows(spark, 600).withColumn("y", F.col("v") * 3 + F.col("w") % 7)
    return VectorAssembler(inputCols=["v", "w"], outputCol="features").transform(raw).select("label", "y", "features")


def nodes(spark, forest):
    return [tuple(r) for r in T.node_table(spark, forest).orderBy("treeID", "id").collect()]


@pytest.mark.parametrize("kind, least", [("classifier", 0), ("regressor", 0), ("regressor", 10_000)])
def test_the_forest_does_not_depend_on_how_rows_lie(spark, kind, least, monkeypatch):
    monkeypatch.setattr(B, "LEAST_ROWS", least)
    est = MD.forest_classifier(numTrees=3) if kind == "classifier" else MD.forest_regressor("y", numTrees=3)
    rows = points(spark)
    one = est.fit(rows.coalesce(1))
    other = est.fit(rows.orderBy(F.desc("y")).repartition(5))
    assert nodes(spark, one) == nodes(spark, other)
    assert one.getNumTrees == 3 and one.numFeatures == 2


def test_first_split_is_the_best_for_the_drawn_weights(spark):
    """The root of each tree against a search through all thresholds by hand."""
    est = MD.forest_regressor("y", numTrees=4, maxDepth=1, minInstancesPerNode=5)
    rows = points(spark)
    own = B.BinnedRows(est, rows)
    parts = own.rows.withColumn("p", F.spark_partition_id()).toPandas()
    total = {t: [] for t in range(4)}
    for p, some in parts.groupby("p"):
        import pyarrow as pa
        cells, each = B.drawer(own.bins, 1, 4, 1.0, True)([pa.RecordBatch.from_pandas(some.drop(columns="p"), preserve_index=False)], p)
        for t, w, wy, wyy in each:
            total[t].append(np.vstack([cells, w, wy, wyy]))
    forest = est.fit(rows)
    for t, root in [(r["treeID"], r) for r in T.node_table(spark, forest).where("id = 0").collect()]:
        every = np.hstack(total[t])
        w, wy, wyy = every[2:]
        sse = lambda m: wyy[m].sum() - wy[m].sum() ** 2 / w[m].sum()
        best = min((sse(left) + sse(~left), f, own.bins.limits[f][b]) for f in (0, 1) for b in range(len(own.bins.limits[f]))
                   for left in [every[f] <= b] if w[left].sum() >= 5 and w[~left].sum() >= 5)
        assert root["n"] == w.sum() and root["value"] == pytest.approx(wy.sum() / w.sum())
        assert (root["slot"], root["split_values"][0]) == best[1:]


def test_draws_are_poisson(spark):
    n = 200_000
    import pyarrow as pa
    bins = B._Bins([np.array([0.5])], {})
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n) % 2), pa.array(np.arange(n) / 1.0), pa.array(np.ones(n, np.int64))], ["k0", "y", "n"])
    seen = []
    for rate in (1.0, 0.3):
        cells, each = B.drawer(bins, 5, 2, rate, True)([batch], 0)
        assert cells.tolist() == [[0, 1]]
        for _, w, wy, _ in each:
            assert w.sum() == pytest.approx(rate * n, rel=0.02)
            assert wy.sum() / w.sum() == pytest.approx((n - 1) / 2, rel=0.01)
            seen.append(tuple(w))
    assert len(set(seen)) == 4


def test_prepared_rows_and_raw_rows_give_the_same_forest(spark):
    raw = raw_rows(spark)
    fitted = recipe().fit(raw)
    vectors = fitted.transform(raw).select("label", "features")
    est = MD.forest_classifier(numTrees=5)
    assert vectors.count() < B.SAMPLE  # all rows give the thresholds
    a = est.fit(vectors)
    b = est.fit(B.remember_raw(fitted.transform(raw).select("label", "features"), fitted, raw))
    assert nodes(spark, a) == nodes(spark, b)


def test_slots_are_the_vector(spark):
    raw = raw_rows(spark)
    fitted = recipe().fit(raw.where("c <> 'b'"))  # b is unseen, and kept
    columns, places = R.vector_slots(fitted, raw, "features")
    got = raw.select(*[e.alias(n) for n, e in columns.items()]).collect()
    want = fitted.transform(raw).select(vector_to_array("features").alias("x")).collect()
    for r, x in zip(got, want):
        assert [r[n] if p is None else float(r[n] == p) for n, p in places] == x["x"]


def test_fits_from_a_summary_are_those_on_the_rows(spark):
    raw = raw_rows(spark)
    summary = R.Summary(recipe(), raw, "fold")
    for without in (None, 0, 3):
        side = raw if without is None else raw.where(F.col("fold") != without)
        a, b = (m.transform(raw).select("features").collect() for m in (summary.fit(without), recipe().fit(side)))
        assert a == b
    assert R.Summary(recipe(), raw.withColumn("v", F.when(F.col("id") > 5, F.col("v")))).fit() is None  # MLlib refuses it


def test_what_is_not_covered_is_mllibs(spark):
    rows = points(spark).withColumn("label", F.pmod(F.col("y"), F.lit(3)).cast("int").cast("double"))
    assert MD.forest_classifier(numTrees=2).fit(rows).numClasses == 3
    assert not B.covers(MD.forest_classifier(bootstrap=False)) and not B.covers(RandomForestClassifier())


def test_hot_cells_are_dealt_over_parts(spark, monkeypatch):
    """All rows in one cell but for a few: no part holds most of them."""
    rows = VectorAssembler(inputCols=["a"], outputCol="features").transform(
        spark.range(4000).select(F.when(F.col("id") < 9, F.col("id")).otherwise(5).cast("double").alias("a"), F.col("id").cast("double").alias("y")))
    own = B.BinnedRows(MD.forest_regressor("y"), rows)
    sizes = [r["count"] for r in own.rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) > 4 and max(sizes) < 2000
