"""Physical-plan checks for the registered queries."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from tabulon.plans import has_node, physical_plan, pushed_filters, python_udf_nodes, read_schemas
from tabulon.sources.tables import read_table

LIGHT = ["claim_status", "join_left", "dedup_by_key", "top_k", "describe_columns", "missing_counts",
         "distinct_counts", "histogram", "kde_density", "value_counts",
         "feature_recipe", "auc_score", "confusion_metrics", "hash_split"]


@pytest.mark.parametrize("name", LIGHT)
def test_no_python_udf_in_plans(spark, name):
    df = E.queries()[name](spark, SF_ORACLE)
    assert python_udf_nodes(df) == []


def test_claim_status_broadcasts_group_stats(spark):
    df = E.queries()["claim_status"](spark, SF_ORACLE)
    text = physical_plan(df)
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text


def test_top_k_is_take_ordered(spark):
    assert has_node(E.queries()["top_k"](spark, SF_ORACLE), "TakeOrderedAndProject")


def test_dedup_is_partial_aggregate_not_window(spark):
    text = physical_plan(E.queries()["dedup_by_category"](spark, SF_ORACLE))
    assert "Window" not in text and "partial_min" in text


def test_kde_has_no_cartesian_or_nested_loop(spark):
    text = physical_plan(E.queries()["kde_density"](spark, SF_ORACLE))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_filter_and_projection_reach_scan(spark):
    from pyspark.sql import functions as F
    li = read_table(spark, SF_ORACLE, "lineitem")
    df = li.where(F.col("l_quantity") > 45).select("l_orderkey", "l_quantity")
    assert any("l_quantity" in f for f in pushed_filters(df))
    assert read_schemas(df) == ["struct<l_orderkey:bigint,l_quantity:double>"]


def test_shapley_plan_has_no_window_and_one_record_shuffle(spark):
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from tabulon.catalog import modeling as MO
    from tabulon.operators import explain as X
    train, test = MO.claims_split(spark, SF_SMALL)
    model = MO.regression_model(train, numTrees=3)
    rows = test.withColumn("row_id", F.concat_ws("|", *[F.col(c).cast("string") for c in MO.RECORD_ID]))
    bg = X.background_sample(train, MO.REG_FEATURES, 4)
    wide = X.shapley_wide(model, rows, "row_id", MO.REG_FEATURES, bg, permutations=2)
    text = physical_plan(wide, "simple")
    assert "Window" not in text and "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert text.count("Exchange hashpartitioning") <= 3  # the record's numbers, and the join to its values


@pytest.mark.parametrize("name,partial", [
    ("value_counts", "partial_count"),
    ("distinct_counts", "HashAggregate"), ("histogram", "partial_count"),
])
def test_grouping_combines_before_the_shuffle(spark, name, partial):
    text = physical_plan(E.queries()[name](spark, SF_ORACLE), "simple")
    lines = text.splitlines()
    first_exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    assert any(partial in l for l in lines[first_exchange + 1:]), "no map-side aggregate under the shuffle"


def test_plans_that_hold_at_scale(spark):
    def plan(name):
        return physical_plan(E.queries()[name](spark, SF_ORACLE), "simple")

    assert "Generate" not in plan("kde_density").split("HashAggregate", 1)[-1]
    assert "keys=[text" not in plan("distinct_counts") and "hashpartitioning(text" not in plan("distinct_counts")
    assert "Join" not in plan("model_roundtrip")
