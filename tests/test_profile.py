"""Profiling operators against brute-force numpy/pandas on small inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import profile as P


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    vals = np.concatenate([rng.normal(100, 15, 997), [100.0, 100.0, 250.0]])  # duplicates + outlier
    rows = [(i, float(v), "abc"[i % 3] if i % 7 else None) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "id bigint, x double, c string"), vals


def test_missing_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r.column_name: r.n_missing for r in P.missing_counts(df).collect()}
    assert got == {"x": 2, "s": 1}


def test_distinct_counts_sorted_and_null_free(numbers):
    df, _ = numbers
    rows = P.distinct_counts(df.withColumn("k", F.lit("same"))).collect()
    assert [(r.column_name, r.n_distinct) for r in rows] == [("c", 3), ("k", 1)]
    approx = P.distinct_counts(df, ["c"], exact=False).first()
    assert approx.n_distinct == 3


def test_describe_matches_pandas(numbers):
    df, vals = numbers
    row = {r.column_name: r for r in P.describe_columns(df).collect()}["x"]
    assert row.n == len(vals)
    assert row.mean == pytest.approx(vals.mean(), abs=1e-6)
    assert row.stddev == pytest.approx(vals.std(ddof=1), abs=1e-6)
    assert (row.min_num, row.max_num) == (vals.min(), vals.max())
    text = {r.column_name: r for r in P.describe_columns(df).collect()}["c"]
    assert text.mean is None and (text.min_str, text.max_str) == ("a", "c")


def test_histogram_counts_and_last_bin(numbers):
    df, vals = numbers
    h = sorted(P.histogram(df, "x", bins=10).collect())
    counts, _ = np.histogram(vals, bins=10)
    assert [r.n for r in h] == list(counts)
    assert sum(r.n for r in h) == len(vals)


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "x double")
    h = P.histogram(df, "x", bins=4).collect()
    assert sum(r.n for r in h) == 5 and len(h) == 4


def test_kde_matches_brute_force(numbers):
    df, vals = numbers
    out = sorted(P.kde_density(df, "x", gridsize=50).collect())
    n = len(vals)
    h = vals.std(ddof=1) * n ** -0.2
    grid = np.linspace(vals.min() - 3 * h, vals.max() + 3 * h, 50)
    dens = np.exp(-0.5 * ((grid[:, None] - vals[None, :]) / h) ** 2).sum(1) / (n * h * math.sqrt(2 * math.pi))
    assert [r.x for r in out] == pytest.approx(grid, abs=1e-3)
    assert [r.density for r in out] == pytest.approx(dens, rel=1e-6, abs=1e-12)
    # integrates to ~1
    assert float(np.trapezoid([r.density for r in out], grid)) == pytest.approx(1.0, abs=0.01)


@pytest.mark.parametrize("c", [1, 4, 32])
def test_binned_kde_keeps_its_bound(spark, c):
    """Against the exact curve, with values on cell edges, repeated ones and far outliers."""
    rng = np.random.default_rng(c)
    vals = np.concatenate([rng.normal(size=400), np.repeat([0.0, 3.0, -7.5], 40), [60.0, -80.0]])
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,), (float("nan"),), (float("inf"),)], "x double")
    exact = {r.i: r for r in P.kde_density(df, "x", gridsize=80).collect()}
    got = P.kde_binned(df, "x", gridsize=80, cells_a_bandwidth=c).collect()
    assert [r.i for r in got] == list(range(80)) and all(r.x == exact[r.i].x for r in got)
    off = [abs(r.density - exact[r.i].density) for r in got]
    assert max(off) <= got[0].max_error + 2e-12 and (c > 1 or max(off) > 1e-6)
    h = vals.std(ddof=1) * len(vals) ** -0.2
    assert got[0].max_error == pytest.approx(1 / (8 * c * c * h * math.sqrt(2 * math.pi)), abs=1e-12)


def test_binned_kde_of_one_value_and_of_nothing(spark):
    same = spark.createDataFrame([(2.5,)] * 5, "x double")
    assert P.kde_binned(same, "x").count() == P.kde_binned(same.limit(0), "x").count() == 0


def test_correlations_match_numpy(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=300)
    b = 2 * a + rng.normal(size=300)
    c = rng.normal(size=300)
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)], "a double, b double, c double")
    m = {(r.col_a, r.col_b): r.corr for r in P.correlation_matrix(df, ["a", "b", "c"]).collect()}
    ref = np.corrcoef(np.vstack([a, b, c]))
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            assert m[(x, y)] == pytest.approx(ref[i, j], abs=1e-6)
    tc = P.target_correlation(df, ["a", "c"], "b").collect()
    assert tc[0].column_name == "b" and tc[0].corr == 1.0 and tc[1].column_name == "a"


@pytest.mark.parametrize("n", [1, 2, 5, 6, 1001, 1200])
def test_exact_median_by_selection(spark, n):
    rng = np.random.default_rng(n)
    vals = np.round(rng.exponential(50, n), 1)  # skewed, with ties
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    # tiny buckets / collect limit force several narrowing rounds
    assert P.exact_median(df, "x", buckets=4) == pytest.approx(float(np.median(vals)), abs=1e-9)


def test_exact_median_skips_null_nan_and_imputes(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,), (10.0,)], "x double")
    assert P.exact_median(df, "x") == 3.0
    out = [r.x for r in P.impute_median(df, ["x"]).collect()]
    assert out == [1.0, 3.0, 3.0, 3.0, 10.0]


def test_drop_uninformative(spark):
    rows = [(i, f"id-{i}", "a" if i % 2 else "b", None) for i in range(50)]
    df = spark.createDataFrame(rows, "k bigint, uid string, cat string, empty double")
    prof, kept = P.drop_uninformative(df)
    flags = {r.column_name: r.drop for r in prof.collect()}
    assert flags == {"k": False, "uid": True, "cat": False, "empty": True}
    assert kept.columns == ["k", "cat"]


def test_schema_table_and_shape(employees):
    rows = P.schema_table(employees).collect()
    assert [(r.column_name, r.data_type, r.role, r.n_non_null) for r in rows] == [
        ("id", "bigint", "numeric", 4), ("name", "string", "categorical", 4),
        ("age", "bigint", "numeric", 4), ("gender", "string", "categorical", 4)]
    s = P.table_shape(employees).first()
    assert (s.n_rows, s.n_cols) == (4, 4)


def test_value_counts_share(employees):
    got = {r.gender: (r.n, r.share) for r in P.value_counts(employees, "gender").collect()}
    assert got == {"Male": (3, 0.75), "Female": (1, 0.25)}


def test_describe_gender_only(employees):
    r = P.describe_columns(employees, ["gender"]).first()
    assert (r.n, r.mean, r.stddev, r.min_str, r.max_str) == (4, None, None, "Female", "Male")


def test_correlation_with_missing_values_is_pairwise(spark):
    import pandas as pd
    rng = np.random.default_rng(4)
    a = rng.normal(size=200)
    b = a + rng.normal(size=200)
    c = rng.normal(size=200)
    a[::7] = np.nan
    c[::5] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b, "c": c})
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    m = {(r.col_a, r.col_b): r.corr for r in P.correlation_matrix(df, ["a", "b", "c"]).collect()}
    ref = pdf.corr()  # pairwise complete observations
    for x in "abc":
        for y in "abc":
            assert m[(x, y)] == pytest.approx(ref.loc[x, y], abs=1e-6)


def test_distinct_counts_by_fingerprint(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    exact = {r.column_name: r.n_distinct for r in P.distinct_counts(docs).collect()}
    fp = {r.column_name: r.n_distinct for r in P.distinct_counts(docs, by_fingerprint=True).collect()}
    assert exact == fp and exact["text"] > 900


def test_exact_median_with_a_hot_value(spark):
    rng = np.random.default_rng(11)
    vals = np.concatenate([np.full(400, 5.0), rng.normal(0, 10, 800)])  # a third on one value
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    assert P.exact_median(df, "x", buckets=8) == pytest.approx(float(np.median(vals)))


def test_infinite_nan_tiny_and_large_values(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1.0, 1e-12, 5e27), (3.0, 3e-12, 5e27), (nan, None, 5e27), (None, nan, 5e27)],
                               "a double, b double, c double")
    r = {x.column_name: x for x in P.describe_columns(df).collect()}
    assert (r["a"].n, r["a"].mean, r["a"].max_num) == (2, 2.0, 3.0)
    assert r["b"].mean == pytest.approx(2e-12, rel=1e-8) and r["b"].stddev == pytest.approx(2 ** 0.5 * 1e-12, rel=1e-8)
    assert r["c"].mean == pytest.approx(5e27) and r["c"].stddev == 0
    e = spark.createDataFrame([(-inf,), (1.0,), (2.0,), (4.0,), (inf,), (inf,), (nan,), (None,)], "x double")
    assert P.exact_median(e, "x", buckets=2) == 3.0
    assert P.exact_median(e.where("x = double('infinity')"), "x") == inf
    big = spark.createDataFrame([(-1.7e308,), (0.5,), (1.7e308,)], "x double")
    assert P.exact_median(big, "x", buckets=4) == 0.5
    h = P.histogram(e, "x", bins=3).collect()
    assert [x.n for x in h] == [1, 1, 1] and h[0].lo == 1.0 and h[-1].hi == 4.0


def test_correlations_skip_nan_by_pair(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, 5.5), (4.0, nan), (5.0, 9.0)], "a double, b double")
    got = {(r.col_a, r.col_b): r["corr"] for r in P.correlation_matrix(df, ["a", "b"]).collect()}
    want = df.toPandas().corr().loc["a", "b"]
    assert got["a", "b"] == pytest.approx(want, abs=1e-6) and got["a", "a"] == got["b", "b"] == 1.0
