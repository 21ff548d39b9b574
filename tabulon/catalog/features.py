"""Feature-engineering queries (indexing, one-hot, dummies, scaling, recipes, split)
and the metric queries over deterministic scored tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabulon.catalog.registry import query, sround, t
from tabulon.functions.scalar import net_amount
from tabulon.operators import features as FE
from tabulon.operators import metrics as M
from tabulon.operators.split import with_bucket
from tabulon.sources.export import features_to_columns

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LK = ", ".join(LINE_KEY)
NET = "l_extendedprice*(1-l_discount)*(1+l_tax)"


def _rank_sql(col: str, table: str, where: str = "") -> str:
    """Index table (v, idx) in StringIndexer order: frequency desc, then value asc."""
    return (f"(select v, row_number() over (order by n desc, v asc) - 1 as idx from "
            f"(select {col} as v, count(*) as n from {table} {where} group by 1))")


# ---------------------------------------------------------------- indexing

@query("string_index", oracle=f"""
select o_orderkey, o_orderpriority, cast(r.idx as double) as o_orderpriority_index
from orders join {_rank_sql('o_orderpriority', 'orders')} r on o_orderpriority = r.v
""")
def q_string_index(spark, sf):
    orders = t(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return FE.index_stage(["o_orderpriority"]).fit(orders).transform(orders)


@query("string_index_keep", oracle=f"""
with r as {_rank_sql('o_orderstatus', 'orders', "where o_orderstatus in ('F', 'O')")}
select o_orderkey, o_orderstatus,
       cast(coalesce(r.idx, (select count(*) from r)) as double) as o_orderstatus_index
from orders left join r on o_orderstatus = r.v
""")
def q_string_index_keep(spark, sf):
    """Fit on finished and open orders, index all: pending ('P') is unseen -> numLabels."""
    orders = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    history = orders.where(F.col("o_orderstatus").isin("F", "O"))
    return FE.index_stage(["o_orderstatus"], handle_invalid="keep").fit(history).transform(orders)


@query("one_hot", oracle=f"""
with r as {_rank_sql('o_orderpriority', 'orders')}
select o_orderkey, {", ".join(f"cast(r.idx = {k} as double) as f_{k}" for k in range(4))}
from orders join r on o_orderpriority = r.v
""")
def q_one_hot(spark, sf):
    """5 priorities -> 4 slots (the least frequent index is the dropped one)."""
    orders = t(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    model = Pipeline(stages=[FE.index_stage(["o_orderpriority"]),
                             FE.one_hot_stage(["o_orderpriority"])]).fit(orders)
    return features_to_columns(model.transform(orders), "o_orderpriority_encoded", 4, keep=["o_orderkey"])


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("dummies_full", oracle="select c_custkey, c_name, c_nationkey, c_acctbal, "
       + ", ".join(f"cast(c_mktsegment = '{v}' as integer) as c_mktsegment_{v}" for v in _SEGMENTS)
       + " from customer")
def q_dummies_full(spark, sf):
    return FE.dummies(t(spark, sf, "customer"), ["c_mktsegment"])


@query("dummies_drop_first", oracle="select c_custkey, c_name, c_nationkey, c_acctbal, "
       + ", ".join(f"cast(c_mktsegment = '{v}' as integer) as c_mktsegment_{v}" for v in _SEGMENTS[1:])
       + " from customer")
def q_dummies_drop_first(spark, sf):
    return FE.dummies(t(spark, sf, "customer"), ["c_mktsegment"], drop_first=True)


# ---------------------------------------------------------------- scaling

_SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _mm(c: str) -> str:
    return (f"case when max({c}) over () = min({c}) over () then 0.5 else "
            f"({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ()) end")


@query("min_max_scale", oracle=f"""
select {LK}, {", ".join(f"round({_mm(c)}, 6) + 0.0 as f_{i}" for i, c in enumerate(_SCALED))}
from lineitem
""")
def q_min_max_scale(spark, sf):
    li = t(spark, sf, "lineitem")
    model = Pipeline(stages=FE.scale_stages(_SCALED)).fit(li)
    return features_to_columns(model.transform(li), "numeric_scaled", len(_SCALED), keep=LINE_KEY)


# ------------------------------------------------------- regression recipe

REG_INDEX = ["l_linestatus", "l_returnflag"]
REG_ONEHOT = ["l_returnflag"]
REG_SCALED = ["l_extendedprice", "l_discount", "l_tax"]
REG_RAW = ["l_quantity"]
REG_WIDTH = 1 + 2 + len(REG_SCALED) + len(REG_RAW)

_REG_SQL = f"""
with ls as {_rank_sql('l_linestatus', 'lineitem')}, rf as {_rank_sql('l_returnflag', 'lineitem')}
select {LK}, {NET} as label,
       cast(ls.idx as double) as f_0,
       cast(rf.idx = 0 as double) as f_1, cast(rf.idx = 1 as double) as f_2,
       {", ".join(f"round({_mm(c)}, 6) + 0.0 as f_{3 + i}" for i, c in enumerate(REG_SCALED))},
       l_quantity as f_6
from lineitem join ls on l_linestatus = ls.v join rf on l_returnflag = rf.v
"""


def regression_pipeline():
    return FE.regression_recipe(REG_INDEX, REG_ONEHOT, REG_SCALED, REG_RAW)


@query("feature_pipeline", oracle=f"select {LK}, f_0, f_1, f_2, f_3, f_4, f_5, f_6 from ({_REG_SQL})")
def q_feature_pipeline(spark, sf):
    li = t(spark, sf, "lineitem")
    model = regression_pipeline().fit(li)
    return features_to_columns(model.transform(li), "features", REG_WIDTH, keep=LINE_KEY)


@query("features_as_array", oracle=f"select {LK}, round(label, 6) as label, f_0, f_1, f_2, f_3, f_4, f_5, f_6 from ({_REG_SQL})")
def q_features_as_array(spark, sf):
    """``vectorize_features``: (label, features) with the target renamed to label."""
    li = t(spark, sf, "lineitem").withColumn("net_amount", net_amount())
    model = FE.regression_recipe(REG_INDEX, REG_ONEHOT, REG_SCALED, output="partial").fit(li)
    staged = model.transform(li)
    inputs = ["l_linestatus_index", "l_returnflag_encoded", "numeric_scaled", "l_quantity"]
    vec = FE.vectorize_features(staged, inputs, "net_amount", keep=LINE_KEY)
    out = features_to_columns(vec, "features", REG_WIDTH, keep=LINE_KEY + ["label"])
    return out.withColumn("label", F.round("label", 6))


@query("feature_names", oracle=f"""
with rf as {_rank_sql('l_returnflag', 'lineitem')}
select 0 as position, 'l_linestatus_index' as feature_name
union all select cast(idx + 1 as integer), 'l_returnflag_encoded_' || v from rf where idx < 2
union all select 3, 'numeric_scaled_0' union all select 4, 'numeric_scaled_1'
union all select 5, 'numeric_scaled_2' union all select 6, 'l_quantity'
""")
def q_feature_names(spark, sf):
    """Slot names read from the fitted vector's metadata (depend on label frequencies)."""
    li = t(spark, sf, "lineitem")
    out = regression_pipeline().fit(li).transform(li)
    names = FE.feature_names(out)
    rows = spark.createDataFrame(list(enumerate(names)), "position int, feature_name string")
    return rows


# Multi-column recipe: keep-unseen indexing + one-hot for categoricals, scaled numerics.
REC_CAT = ["l_returnflag", "l_linestatus"]
REC_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("feature_recipe", oracle=f"""
with rf as {_rank_sql('l_returnflag', 'lineitem')}, ls as {_rank_sql('l_linestatus', 'lineitem')}
select {LK},
       {", ".join(f"cast(rf.idx = {k} as double) as f_{k}" for k in range(3))},
       {", ".join(f"cast(ls.idx = {k} as double) as f_{3 + k}" for k in range(2))},
       {", ".join(f"round({_mm(c)}, 6) + 0.0 as f_{5 + i}" for i, c in enumerate(REC_NUM))}
from lineitem join rf on l_returnflag = rf.v join ls on l_linestatus = ls.v
""")
def q_feature_recipe(spark, sf):
    li = t(spark, sf, "lineitem")
    model = FE.feature_recipe(REC_CAT, REC_NUM).fit(li)
    return features_to_columns(model.transform(li), "features", 3 + 2 + len(REC_NUM), keep=LINE_KEY)


# 18 + 18 columns as in the reference's fraud recipe, most with hyphens in their names.
WIDE_CAT = ["l_returnflag", "l_linestatus"] + [f"key-mod-{k}" for k in range(2, 18)]
WIDE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"] + [f"part-mod-{k}" for k in range(3, 17)]


def _wide_lineitem(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select(*LINE_KEY, "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     *[(F.col("l_orderkey") % k).cast("string").alias(f"key-mod-{k}") for k in range(2, 18)],
                     *[(F.col("l_partkey") % k).cast("double").alias(f"part-mod-{k}") for k in range(3, 17)])


_WIDE_X = {c: c if c.startswith("l_") else f"l_partkey % {c.rsplit('-', 1)[1]}" for c in WIDE_NUM}
_WIDE_C = {c: c if c.startswith("l_") else f"l_orderkey % {c.rsplit('-', 1)[1]}" for c in WIDE_CAT}


@query("feature_recipe_wide", oracle=f"""
with s as (select {" + ".join(f"count(distinct {x})" for x in _WIDE_C.values())} + {len(WIDE_NUM)} as n_slots,
           {", ".join(f"min({x})::double as lo{i}, max({x})::double as hi{i}" for i, x in enumerate(_WIDE_X.values()))}
           from lineitem)
select l_orderkey, l_partkey, l_suppkey, l_linenumber, n_slots, {float(len(WIDE_CAT))}::double as onehot_sum,
       round({" + ".join(f"(case when hi{i} = lo{i} then 0.5 else ({x} - lo{i}) / (hi{i} - lo{i}) end)"
                         for i, x in enumerate(_WIDE_X.values()))}, 6) as scaled_sum,
       {len(WIDE_NUM)} as n_normalized
from lineitem, s
""")
def q_feature_recipe_wide(spark, sf):
    """The recipe over 18 categorical and 18 numeric columns: slots, one hot value for each
    category, and the sum of the scaled values; every scaled slot is named by its column."""
    df = _wide_lineitem(spark, sf)
    out = FE.feature_recipe(WIDE_CAT, WIDE_NUM).fit(df).transform(df)
    names = FE.feature_names(out, scaled=WIDE_NUM)
    named = [n for n in names if n.endswith("_normalized")]
    onehot_sum, scaled_sum = FE.block_sums(F.col("features"), len(names) - len(WIDE_NUM))
    return out.select(*LINE_KEY, F.lit(len(names)).cast("long").alias("n_slots"),
                      onehot_sum.alias("onehot_sum"), F.round(scaled_sum, 6).alias("scaled_sum"),
                      F.lit(sum(f"{c}_normalized" == n for c, n in zip(WIDE_NUM, named))).alias("n_normalized"))


# ------------------------------------------------------------------ split

@query("hash_split", oracle="""
select o_orderkey, cast(cast('0x' || substr(md5(cast(o_orderkey as varchar) || '|123'), 1, 8) as bigint) % 100 as integer) as bucket,
       case when cast('0x' || substr(md5(cast(o_orderkey as varchar) || '|123'), 1, 8) as bigint) % 100 < 80
            then 'train' else 'test' end as side
from orders
""")
def q_hash_split(spark, sf):
    orders = with_bucket(t(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], seed=123)
    return orders.withColumn("side", F.when(F.col("bucket") < 80, "train").otherwise("test"))


# ---------------------------------------------------------------- metrics
# Scored tables built from the data itself so that an oracle can recompute them:
# label = line charged over 50,000; scores = quantity (many ties) or list price.

_SCORED = f"(select cast({NET} > 50000 as integer) as y, {{p}} as p from lineitem)"
_AUC_SQL = """
with g as (select p, sum(y) as np, sum(1 - y) as nn from {s} group by p),
     c as (select *, sum(nn) over (order by p rows between unbounded preceding and current row) - nn as below from g)
select round(cast(sum(np * (below + nn / 2.0)) / (sum(np) * sum(nn)) as double), 6) as auc,
       cast(sum(np) as bigint) as n_pos, cast(sum(nn) as bigint) as n_neg from c
"""


def _scored(spark, sf, score):
    li = t(spark, sf, "lineitem")
    return li.select((net_amount() > 50000).cast("int").alias("label"), F.col(score).alias("score"))


@query("auc_score", oracle=_AUC_SQL.format(s=_SCORED.format(p="l_quantity")))
def q_auc_score(spark, sf):
    return M.auc(_scored(spark, sf, "l_quantity"))


@query("auc_score_distinct", oracle=_AUC_SQL.format(s=_SCORED.format(p="l_extendedprice")))
def q_auc_score_distinct(spark, sf):
    """Nearly all scores distinct: exercises the bucketed running count."""
    return M.auc(_scored(spark, sf, "l_extendedprice"))


@query("regression_metrics", oracle=f"""
with s as (select {NET} as y, l_extendedprice * (1 - l_discount) as p from lineitem),
     a as (select count(*) as n, sum((y - p) * (y - p)) as sse, var_pop(y) as vy from s)
select n, {sround('sse / n', 2)} as mse, {sround(f"sqrt({sround('sse / n', 2)})", 2)} as rmse,
       {sround('1 - sse / (vy * n)', 4)} as r2 from a
""")
def q_regression_metrics(spark, sf):
    """Pre-tax amount as the prediction of the charged amount."""
    li = t(spark, sf, "lineitem")
    scored = li.select(net_amount().alias("label"),
                       (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("prediction"))
    return M.regression_metrics(scored)


@query("confusion_metrics", oracle=f"""
with s as (select cast({NET} > 50000 as integer) as y, cast(l_extendedprice > 50000 as integer) as p from lineitem),
     c as (select cast(count_if(y = 1 and p = 1) as bigint) as tp, cast(count_if(y = 0 and p = 1) as bigint) as fp,
                  cast(count_if(y = 0 and p = 0) as bigint) as tn, cast(count_if(y = 1 and p = 0) as bigint) as fn from s),
     d as (select *, cast(tp as double) as dtp, cast(fp as double) as dfp, cast(tn as double) as dtn,
                  cast(fn as double) as dfn from c)
select tp, fp, tn, fn,
       round((dtp + dtn) / (dtp + dfp + dtn + dfn), 6) as accuracy,
       round(dtp / (dtp + dfp), 6) as precision, round(dtp / (dtp + dfn), 6) as recall,
       round(2 * (dtp / (dtp + dfp)) * (dtp / (dtp + dfn)) / ((dtp / (dtp + dfp)) + (dtp / (dtp + dfn))), 6) as f1,
       round((((dtp + dtn) / (dtp + dfp + dtn + dfn)) - (((dtp + dfp) * (dtp + dfn) + (dfn + dtn) * (dfp + dtn)) / ((dtp + dfp + dtn + dfn) * (dtp + dfp + dtn + dfn))))
             / (1 - (((dtp + dfp) * (dtp + dfn) + (dfn + dtn) * (dfp + dtn)) / ((dtp + dfp + dtn + dfn) * (dtp + dfp + dtn + dfn)))), 6) as kappa,
       round((dtp * dtn - dfp * dfn) / sqrt((dtp + dfp) * (dtp + dfn) * (dtn + dfp) * (dtn + dfn)), 6) as mcc
from d
""")
def q_confusion_metrics(spark, sf):
    """List price over 50,000 as a classifier of 'charged over 50,000'."""
    li = t(spark, sf, "lineitem")
    scored = li.select((net_amount() > 50000).cast("int").alias("label"),
                       (F.col("l_extendedprice") > 50000).cast("int").alias("prediction"))
    return M.confusion_metrics(scored)


@query("string_index_table", oracle="""
with v as (select concat(l_orderkey, '-', l_partkey % 40) as v, l_quantity from lineitem),
     labels as (select v, row_number() over (order by count(*) desc, v) - 1 as label from v group by v)
select v.v as key, l_quantity, cast(label as double) as key_index from v join labels on labels.v = v.v
""")
def q_string_index_table(spark, sf):
    """Labels of a column of nearly as many values as rows, ranked and joined on the cluster."""
    df = t(spark, sf, "lineitem").select(F.concat("l_orderkey", F.lit("-"), F.col("l_partkey") % 40).alias("key"), "l_quantity")
    return FE.index_by_table(df, "key", FE.label_table(df, "key"))
