"""Profiles over hard values: decimals, shorts, huge and tiny numbers, longs beyond 2**53; wide
correlations; label tables."""

import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tabulon.operators import features as FE
from tabulon.operators import profile as P


def test_describe_of_every_number_type(spark):
    df = spark.createDataFrame([(1, 2, Decimal("1.50")), (3, None, Decimal("-2.25"))], "a short, b byte, c decimal(20,2)")
    got = {r["column_name"]: r for r in P.describe_columns(df).collect()}
    assert got["a"]["mean"] == 2.0 and got["b"]["n"] == 1 and (got["c"]["min_num"], got["c"]["max_num"]) == (-2.25, 1.5)
    assert P.describe_columns(spark.createDataFrame([(True,)], "x boolean")).count() == 0


def test_moments_of_huge_and_tiny_numbers(spark):
    df = spark.createDataFrame([(1e308, 1e-300, 1e308), (1e308, 3e-300, -1e308), (None, float("nan"), 0.0)],
                               "a double, b double, c double")
    got = {r["column_name"]: r for r in P.describe_columns(df).collect()}
    assert (got["a"]["mean"], got["a"]["stddev"]) == (1e308, 0.0) and got["b"]["mean"] == 2e-300
    assert got["c"]["mean"] == 0.0 and got["c"]["stddev"] == 1e308
    inf = spark.createDataFrame([(math.inf,), (1.0,)], "a double")
    assert P.describe_columns(inf).first()["mean"] == math.inf


def test_histogram_of_the_whole_range(spark):
    df = spark.createDataFrame([(-1.7e308,), (1.7e308,), (0.0,), (math.inf,), (math.nan,), (None,)], "x double")
    got = P.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in got] == [1, 0, 1, 1] and got[0]["lo"] == -1.7e308 and got[3]["hi"] == 1.7e308
    assert all(math.isfinite(r["lo"]) and math.isfinite(r["hi"]) for r in got)


def test_exact_medians_of_longs_and_decimals(spark):
    big = 9007199254740993
    rows = [(big, Decimal("0.1000000000000000001"), 1.0), (big, Decimal("0.1000000000000000003"), -1e308),
            (2 ** 63 - 1, Decimal("7"), 1e308), (-2 ** 63, Decimal("-7"), None), (None, None, math.nan)]
    df = spark.createDataFrame(rows, "a long, b decimal(38,19), c double")
    got = P.exact_medians(df, ["a", "b", "c"], buckets=4)
    assert got == {"a": big, "b": Decimal("0.1000000000000000002"), "c": 1.0}
    filled = P.impute_median(df.where("a is null or a != 5"), ["a", "b"]).collect()
    assert filled[4]["a"] == big and filled[2]["a"] == 2 ** 63 - 1
    between = P.impute_median(spark.createDataFrame([(1,), (2,), (None,)], "a int"), ["a"])
    assert sorted(r["a"] for r in between.collect()) == [1, Decimal("1.5"), 2]
    rng = np.random.default_rng(3)
    x = rng.integers(-2 ** 62, 2 ** 62, 3001)
    df = spark.createDataFrame([(int(v),) for v in x], "a long")
    assert P.exact_median(df, "a", buckets=16) == sorted(x.tolist())[1500]


def test_wide_correlations_are_those_of_pandas(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 60)) @ rng.normal(size=(60, 60)) + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7] = 0.1  # does not vary
    x[:, 8] = np.nan
    x[1:, 9] = np.nan  # one value
    cols = [f"c {i}" for i in range(60)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols)).repartition(5)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in P.correlation_matrix(df, cols).collect()}
    assert len(got) == 3600
    want = pd.DataFrame(x, columns=cols).corr().to_numpy()
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if {7, 8, 9} & {i, j}:
                assert got[a, b] is None
            else:
                assert abs(got[a, b] - want[i, j]) < 2e-6
    empty = P.correlation_matrix(df.limit(0), cols[:2])
    assert empty.count() == 0
    odd = spark.createDataFrame([(1.0, math.inf), (2.0, 1.0), (3.0, 5.0)], "a double, b double")
    assert {r["corr"] for r in P.correlation_matrix(odd, ["a", "b"]).where("col_a != col_b").collect()} == {None}


def test_label_table_is_the_string_indexer_s(spark):
    df = spark.range(3000).selectExpr("case when id % 3 = 0 then 'hot' when id % 11 = 0 then null else concat('v', id % 83) end as c",
                                      "id")
    table = FE.label_table(df, "c")
    model = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(df)
    assert [r["value"] for r in table.orderBy("label").collect()] == list(model.labels)
    other = df.unionByName(spark.createDataFrame([("new", -1)], "c string, id long"))
    want = {r["id"]: r["i"] for r in model.transform(other).collect()}
    got = FE.index_by_table(other, "c", table, "i", "keep", rows_per_task=100).collect()
    assert {r["id"]: r["i"] for r in got} == want and len(got) == 3001
    assert FE.index_by_table(other, "c", table, "i", "skip").count() == df.where("c is not null").count()
    with pytest.raises(ValueError):
        FE.index_by_table(other, "c", table, "i")
    assert FE.label_table(df.limit(0), "c").count() == 0


def test_a_million_labels(spark):
    df = spark.range(1_050_000).selectExpr("concat('user-', id) as c").unionByName(spark.createDataFrame([("user-77",)], "c string"))
    table = FE.label_table(df, "c")
    top = table.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("d"), F.max("label").alias("hi")).first()
    assert (top["n"], top["d"], top["hi"]) == (1_050_000, 1_050_000, 1_049_999.0)
    assert table.where("label in (0, 1)").orderBy("label").select("value").collect() == [("user-77",), ("user-0",)]


def test_label_table_over_ranges_of_few_rows(spark, monkeypatch):
    """Ranges and join tasks follow the number of rows; labels are the indexer's all the same."""
    from tabulon.operators import joins as J

    monkeypatch.setattr(FE, "LABELS_A_RANGE", 20)
    monkeypatch.setattr(J, "ROWS_A_JOIN_TASK", 40)
    df = spark.range(300).select(F.when(F.col("id") % 50 > 0, F.concat(F.lit("v"), F.col("id") % 120)).alias("c"))
    table = FE.label_table(df, "c")
    got = FE.index_by_table(df, "c", table, "i", "skip")
    assert got.rdd.getNumPartitions() == -(-(300 + table.count()) // 40)
    want = StringIndexer(inputCol="c", outputCol="i", handleInvalid="skip").fit(df).transform(df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(r["label"] for r in table.collect()) == [float(i) for i in range(table.count())]


def test_block_sums_of_sparse_and_dense_vectors(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(1, Vectors.sparse(6, [1, 3, 5], [1.0, 0.5, 0.25])), (2, Vectors.dense([1, 0, 2, 3, 0, 4])),
            (3, Vectors.sparse(6, [], [])), (4, Vectors.sparse(6, [4], [0.5])), (5, None)]
    a, b = FE.block_sums(F.col("v"), 3)
    got = spark.createDataFrame(rows, ["id", "v"]).select("id", a, b).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 1.0, 0.75), (2, 3.0, 7.0), (3, 0.0, 0.0), (4, 0.0, 0.5), (5, None, None)]
