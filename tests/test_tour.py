"""Operator tour on the inline employees/salaries tables (expected values from the tour)."""

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tabulon.functions.scalar import binary_label, decode_labels, threshold_flag
from tabulon.operators import columns as C
from tabulon.operators.dedup import dedup_by_key, distinct_rows
from tabulon.operators.joins import equi_join, with_small
from tabulon.operators.ordering import top_k


@pytest.mark.parametrize("how,ids", [
    ("inner", [1, 2, 3]), ("left", [1, 2, 3, 5]), ("right", [1, 2, 3, 4]),
    ("outer", [1, 2, 3, 4, 5]), ("leftsemi", [1, 2, 3]), ("leftanti", [5]),
])
def test_six_joins(employees, salaries, how, ids):
    out = equi_join(employees, salaries, "id", how)
    assert sorted(r.id for r in out.collect()) == ids
    if how in ("leftsemi", "leftanti"):
        assert out.columns == employees.columns
    else:
        assert out.columns.count("id") == 1


def test_right_and_outer_coalesce_key(employees, salaries):
    out = equi_join(employees, salaries, "id", "outer").where(F.col("id") == 4).first()
    assert out.id == 4 and out.name is None and out.salary == 25000


def test_copy_drop_null_fill(employees):
    df = C.copy_columns(employees, {"age2": "age", "age3": "age"})
    df = C.drop_columns(df, F.col("age3"), "not_there")
    assert df.columns == ["id", "name", "age", "gender", "age2"]
    df = C.set_null_where(df, "age2", F.col("id") == 1)
    rows = {r.id: r.age2 for r in df.collect()}
    assert rows[1] is None and rows[2] == 30
    filled = {r.id: r.age2 for r in C.fill_missing(df, {"age2": 0}).collect()}
    assert filled[1] == 0


def test_concat_key_and_null(spark, employees):
    keys = sorted(r.key for r in employees.selectExpr("id", "name", "concat(id, name) as key").collect())
    assert keys == ["1Mike", "2Lily", "3Raymond", "5Dave"]
    n = spark.createDataFrame([(1, None)], "id bigint, name string").selectExpr("concat(id, name) as k").first().k
    assert n is None


def test_dedup_and_distinct(employees):
    assert distinct_rows(employees, ["gender"]).count() == 2
    first = dedup_by_key(employees, ["gender"], ["age"]).collect()
    assert {(r.gender, r.name) for r in first} == {("Male", "Raymond"), ("Female", "Lily")}
    assert dedup_by_key(employees, ["gender"], ["age"]).columns == employees.columns


def test_label_encode_does_not_fail_on_other_text(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("?",), ("7",), (None,)], "f string")
    got = [r.v for r in df.select(binary_label("f", {"Y": 1, "N": 0}).alias("v")).collect()]
    assert got == [1, 0, None, 7, None]
    # the naive mixed-type CASE fails under ANSI mode — the reason for try_cast
    naive = F.when(F.col("f") == "Y", 1).when(F.col("f") == "N", 0).otherwise(F.col("f")).cast("int")
    with pytest.raises(Exception):
        df.select(naive.alias("v")).collect()


def test_decode_prediction_keeps_other_codes(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "prediction double")
    out = [r["Model Prediction"] for r in C.decode_prediction(df).collect()]
    assert out == ["Normal Policy", "Abnormal Policy", "2.0"]


def test_threshold_flag_null_is_normal(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (None, 1.0), (1.0, 1.0)], "e double, a double")
    out = [r.s for r in df.select(threshold_flag("e", "a").alias("s")).collect()]
    assert out == ["Abnormal Claim", "Normal Claim", "Normal Claim", "Normal Claim"]


def test_round_half_up(spark):
    r = spark.range(1).select(F.round(F.lit(2.675), 2).alias("a"), F.round(F.lit(2.5), 0).alias("b")).first()
    assert (r.a, r.b) == (2.68, 3.0)


def test_with_small_broadcasts_only_when_small(spark, employees, salaries):
    j = with_small(employees, salaries, "id", "inner")
    assert "BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()
    big = with_small(employees, salaries, "id", "inner", max_rows=2)
    assert sorted(r.id for r in big.collect()) == [1, 2, 3]


def test_top_k_and_split_by_type(employees):
    assert [r.name for r in top_k(employees, 2, [F.desc("age")]).collect()] == ["Dave", "Lily"]
    numeric, categorical = C.split_by_type(employees.schema)
    assert numeric == ["id", "age"] and categorical == ["name", "gender"]
    assert C.columns_except(employees, ["age"]) == ["id", "name", "gender"]


def test_hyphenated_columns(spark):
    from tabulon.operators.profile import describe_columns, missing_counts
    df = spark.createDataFrame([(1, 2.0), (None, float("nan"))], "`capital-gains` int, `capital-loss` double")
    m = {r.column_name: r.n_missing for r in missing_counts(df).collect()}
    assert m == {"capital-gains": 1, "capital-loss": 1}
    assert describe_columns(df).count() == 2


@pytest.mark.parametrize("how", ["inner", "left", "leftsemi", "leftanti"])
def test_salted_join_equals_plain_join(spark, how):
    from tabulon.operators.joins import salted_join
    left = spark.range(3000).selectExpr("case when id % 3 = 0 then 7 when id % 5 = 0 then null else id % 50 end as k",
                                        "id")
    right = spark.range(60).selectExpr("id % 40 as k", "id * 10 as v")
    plain = sorted((tuple(r) for r in left.join(right, "k", how).collect()), key=str)
    salted = sorted((tuple(r) for r in salted_join(left, right, ["k"], how, rows_per_task=200).collect()),
                    key=str)
    assert salted == sorted(plain, key=str)


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer", "leftsemi", "leftanti"])
@pytest.mark.parametrize("rows", [40, 100_000])
def test_skew_join_equals_plain_join(spark, how, rows):
    """Keys hot on both sides (with equal rows), on one, and absent from the other; NULL keys;
    a key of two columns; names that both sides have only in the key."""
    import collections

    from tabulon.operators.joins import skew_join
    left = spark.range(1200).selectExpr("case when id % 3 = 0 then 7 when id % 5 = 0 then null when id % 7 = 0 then 100 "
                                        "else id % 50 end as k", "'x' as c", "id % 20 as `a b`")
    right = spark.range(500).selectExpr("case when id % 2 = 0 then 7 when id % 5 = 0 then 200 when id % 11 = 0 then null "
                                        "else id % 60 end as k", "if(id % 9 = 0, 'y', 'x') as c", "id % 3 as v")
    plain = left.join(right, ["k", "c"], how)
    got = skew_join(left.repartition(3), right, ["k", "c"], how, rows_per_task=rows)
    assert got.columns == plain.columns and got.schema.simpleString() == plain.schema.simpleString()
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(map(tuple, plain.collect()))
    assert skew_join(left.limit(0), right.limit(0), ["k", "c"], how).count() == 0


def test_skew_join_spreads_a_key_hot_on_both_sides(spark):
    from tabulon.operators.joins import skew_join
    left, right = spark.range(4000).selectExpr("1 as k", "0 as a"), spark.range(300).selectExpr("1 as k", "0 as b")
    out = skew_join(left, right, "k", "inner", rows_per_task=100).withColumn("p", F.spark_partition_id())
    assert out.count() == 1_200_000
    with pytest.raises(ValueError):
        skew_join(left, right, "k", "cross")


def test_skew_join_repeats_rows_by_a_bounded_factor(spark):
    """With a grid as fine as its parts, rows are repeated with the square of the input."""
    from tabulon.operators.joins import MAX_CELLS, grid_parts
    sizes = [(0, 900), (900, 0), (300, 900), (50_000, 1_500), (3_000_000, 90_000), (90_000, 3_000_000), (1, 40_000_000), (10**9, 10**9)]
    df = spark.createDataFrame(sizes, "n long, m long").select("n", "m", *grid_parts(F.col("n"), F.col("m"), 400))
    for n, m, i, j in map(tuple, df.collect()):
        assert n * j + m * i <= 2 * MAX_CELLS ** 0.5 * (n + m)
        assert i <= -(-n // 400) and j <= -(-m // 400) and (i == 0) == (n == 0) and (j == 0) == (m == 0)


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer", "leftsemi", "leftanti"])
def test_skew_join_with_empty_cells(spark, how, monkeypatch):
    """More parts than a side has rows in some: no row is lost or added in a cell without partners."""
    import collections

    from tabulon.operators import joins as J
    monkeypatch.setattr(J, "MAX_CELLS", 6)
    left = spark.range(90).selectExpr("if(id % 4 = 0, null, if(id % 3 = 0, 5, 7)) as k", "id % 2 as a")
    right = spark.range(40).selectExpr("if(id % 5 = 0, null, if(id % 3 = 0, 9, 7)) as k", "id % 2 as b")
    plain = left.join(right, "k", how)
    got = J.skew_join(left.repartition(7), right.repartition(5), "k", how, rows_per_task=2)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(map(tuple, plain.collect()))


def test_dedup_of_rows_with_maps(spark):
    from tabulon.operators.dedup import dedup_by_key
    df = spark.createDataFrame([(1, 5, {"b": 2, "a": 1}), (1, 5, {"a": 0}), (2, 1, None)], "k int, o int, m map<string,int>")
    got = {r["k"]: r["m"] for r in dedup_by_key(df, ["k"], ["o"]).collect()}
    assert got == {1: {"a": 0}, 2: None}
