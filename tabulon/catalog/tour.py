"""Operator tour: sources, column edits, scalar functions, joins, dedup, ordering.

Driver tables stand in for the tour's inline employees/salaries: ``documents`` /
``labels`` (labels cover 399 of 1000 documents) and per-day order and shipment
totals (each side has days the other lacks) for the right and full joins.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tabulon.catalog.registry import query, sround, t
from tabulon.functions.scalar import net_amount, null_when, threshold_flag
from tabulon.operators import columns as C
from tabulon.operators.dedup import dedup_by_key, distinct_rows
from tabulon.operators.joins import equi_join, salted_join, skew_join, with_small
from tabulon.operators.ordering import limit_rows, sort_desc, top_k
from tabulon.session import shared_path
from tabulon.sources.csv import read_csv, write_csv
from tabulon.sources.inline import inline_table

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

_sround = sround

NET = "l_extendedprice*(1-l_discount)*(1+l_tax)"

# ------------------------------------------------------------------- sources


@query("inline_rows", oracle="""
select f.l_returnflag, f.n, v.description
from (select l_returnflag, count(*) as n from lineitem group by l_returnflag) f
join (values ('A', 'accepted'), ('N', 'not returned'), ('R', 'returned')) v(l_returnflag, description)
  using (l_returnflag)
""")
def q_inline_rows(spark, sf):
    # A hand-typed lookup of the three return flags.
    flags = inline_table(spark, [("A", "accepted"), ("N", "not returned"), ("R", "returned")],
                         "l_returnflag string, description string")
    counts = t(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(flags), "l_returnflag")  # inline side: <= 10k rows by contract


CUSTOMER_CSV_SCHEMA = StructType([
    StructField("c_custkey", LongType()), StructField("c_name", StringType()),
    StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType()), StructField("c_acctbal2", DoubleType()),
])


@query("csv_roundtrip", oracle="""
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       case when c_acctbal < 0 then null else c_acctbal end as c_acctbal2
from customer
""")
def q_csv_roundtrip(spark, sf):
    cust = t(spark, sf, "customer").withColumn(
        "c_acctbal2", null_when(F.col("c_acctbal") < 0, "c_acctbal"))
    path = write_csv(cust, shared_path(spark, "csv", unique=True))
    return read_csv(spark, path, CUSTOMER_CSV_SCHEMA)


@query("csv_documents", oracle="select doc_id, text, lang, source, n_chars from documents")
def q_csv_documents(spark, sf):
    """All columns and whole texts of documents through CSV files: quotes, line breaks, empty
    texts and all."""
    path = write_csv(t(spark, sf, "documents"), shared_path(spark, "csv", unique=True))
    return read_csv(spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint", line_sep="\n")


# ------------------------------------------------------------- projections


@query("project", oracle="select c_custkey, c_name, c_mktsegment from customer")
def q_project(spark, sf):
    return t(spark, sf, "customer").select(F.col("c_custkey"), "c_name", "c_mktsegment")


@query("project_expr", oracle="""
select c_custkey, c_name, cast(c_custkey as varchar) || c_name as key from customer
""")
def q_project_expr(spark, sf):
    return t(spark, sf, "customer").selectExpr("c_custkey", "c_name", "concat(c_custkey, c_name) as key")


@query("add_column", oracle="""
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_acctbal as c_acctbal2 from customer
""")
def q_add_column(spark, sf):
    return C.copy_columns(t(spark, sf, "customer"), {"c_acctbal2": "c_acctbal"})


@query("drop_column", oracle="select c_custkey, c_nationkey, c_acctbal, c_mktsegment from customer")
def q_drop_column(spark, sf):
    df = C.copy_columns(t(spark, sf, "customer"), {"c_acctbal3": "c_acctbal"})
    return C.drop_columns(df, F.col("c_acctbal3"), "c_name", "no_such_column")


@query("rename_column", oracle="select o_orderkey, o_totalprice as label from orders")
def q_rename_column(spark, sf):
    df = t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return C.rename_columns(df, {"o_totalprice": "label"})


@query("conditional_null", oracle="""
select c_custkey, c_acctbal, case when c_acctbal < 0 then null else c_acctbal end as c_acctbal2
from customer
""")
def q_conditional_null(spark, sf):
    df = t(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return C.set_null_where(df, "c_acctbal", F.col("c_acctbal") < 0, into="c_acctbal2")


@query("fill_nulls", oracle="""
select c_custkey, c_acctbal, coalesce(case when c_acctbal < 0 then null else c_acctbal end, 0) as c_acctbal2
from customer
""")
def q_fill_nulls(spark, sf):
    df = q_conditional_null(spark, sf)
    return C.fill_missing(df, {"c_acctbal2": 0})


@query("label_encode", oracle="""
select o_orderkey, o_orderstatus,
       case when o_orderstatus = 'F' then 1 when o_orderstatus = 'O' then 0
            else try_cast(o_orderstatus as integer) end as o_status_code
from orders
""")
def q_label_encode(spark, sf):
    df = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return C.encode_binary(df, "o_orderstatus", {"F": 1, "O": 0}, into="o_status_code")


@query("label_map", oracle="""
select o_orderkey, o_orderstatus,
       case when o_orderstatus = 'F' then 1 when o_orderstatus = 'O' then 0 end as o_status_code
from orders
""")
def q_label_map(spark, sf):
    df = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return C.encode_map(df, "o_orderstatus", {"F": 1, "O": 0}, into="o_status_code")


@query("decode_prediction", oracle="""
select doc_id, cast(quality + toxic as double) as prediction,
       case when cast(quality + toxic as double) = 0 then 'Normal Policy'
            when cast(quality + toxic as double) = 1 then 'Abnormal Policy'
            else cast(cast(quality + toxic as double) as varchar) end as "Model Prediction"
from labels
""")
def q_decode_prediction(spark, sf):
    df = t(spark, sf, "labels").select(
        "doc_id", (F.col("quality") + F.col("toxic")).cast("double").alias("prediction"))
    return C.decode_prediction(df, "prediction")


@query("join_skewed", oracle=f"""
with l as (select *, case when l_quantity < 5 then null else l_returnflag end as flag from lineitem),
     g as (select l_returnflag as flag, count(*) as n_flag, max(l_shipdate) as last_ship from lineitem group by 1)
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l.flag, n_flag, last_ship
from l left join g on l.flag = g.flag
""")
def q_join_skewed(spark, sf):
    """Left join on a key of three values and NULL, its hot keys split over tasks."""
    li = t(spark, sf, "lineitem")
    flags = li.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("n_flag"),
                                                                F.max("l_shipdate").alias("last_ship"))
    left = li.withColumn("flag", F.when(F.col("l_quantity") < 5, None).otherwise(F.col("l_returnflag")))
    return salted_join(left.select(*LINE_KEY, "l_extendedprice", "flag"), flags, ["flag"], "left", rows_per_task=1000)


# A key that holds a third of the orders and a tenth of the customers, keys that only one
# side has, and NULLs.
_SKEW_O = "case when o_orderkey % 3 = 0 then 1 when o_orderkey % 97 = 0 then null when o_orderkey % 5 = 0 then -2 else o_custkey end"
_SKEW_C = "case when c_custkey % 10 = 0 then 1 when c_custkey % 89 = 0 then null when c_custkey % 7 = 0 then -3 else c_custkey end"
_SKEW_SIDES = f"""l as (select {_SKEW_O} as k, o_orderkey from orders),
     r as (select {_SKEW_C} as k, c_custkey, c_nationkey from customer)"""


def _skewed(how, sql):
    exists = how in ("leftsemi", "leftanti")
    sums = "count(*) as n, sum(o_orderkey)::bigint as orders" + (
        "" if exists else ", sum(c_custkey)::bigint as customers, count(c_nationkey) as nations")

    @query(f"join_skewed_{how.removeprefix('left') if exists else how}", oracle=f"""
with {_SKEW_SIDES},
     j as ({sql})
select k, {sums} from j group by k
""")
    def run(spark, sf):
        left = t(spark, sf, "orders").selectExpr(f"{_SKEW_O} as k", "o_orderkey")
        right = t(spark, sf, "customer").selectExpr(f"{_SKEW_C} as k", "c_custkey", "c_nationkey")
        out = [F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("orders")]
        if not exists:
            out += [F.sum("c_custkey").alias("customers"), F.count("c_nationkey").alias("nations")]
        return skew_join(left, right, "k", how, rows_per_task=400).groupBy("k").agg(*out)
    run.__doc__ = f"{how} join on a key that is hot on both sides, every key's rows counted and summed."


for _how, _kind in (("inner", "join"), ("left", "left join"), ("right", "right join"), ("outer", "full join")):
    _skewed(_how, f"select coalesce(l.k, r.k) as k, o_orderkey, c_custkey, c_nationkey from l {_kind} r on l.k = r.k")
_skewed("leftsemi", "select * from l where k in (select k from r where k is not null)")
_skewed("leftanti", "select * from l where not exists (select 1 from r where r.k = l.k)")


@query("claim_status", oracle=f"""
with li as (select *, {NET} as net from lineitem),
     g as (select l_returnflag, l_linestatus, avg(net) as expected from li group by 1, 2)
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
       {_sround('g.expected', 2)} as "Expected_Expenses",
       {_sround('li.net', 2)} as "Actual_Expenses",
       case when {_sround('g.expected', 2)} < {_sround('li.net', 2)}
            then 'Abnormal Claim' else 'Normal Claim' end as "Claim_Status"
from li join g using (l_returnflag, l_linestatus)
""")
def q_claim_status(spark, sf):
    """Flag lines charged above their group's average (a baseline 'expected' amount).

    The per-group averages (one row per flag/status pair) are attached by a
    size-checked broadcast, so the large side is never shuffled on a 6-value key.
    """
    li = t(spark, sf, "lineitem").withColumn("net", net_amount())
    keys = ["l_returnflag", "l_linestatus"]
    expected = li.groupBy(*keys).agg(F.avg("net").alias("expected"))
    j = with_small(li, expected, keys, "inner")
    return (j.select(*LINE_KEY,
                     F.round("expected", 2).alias("Expected_Expenses"),
                     F.round("net", 2).alias("Actual_Expenses"))
             .withColumn("Claim_Status", threshold_flag("Expected_Expenses", "Actual_Expenses")))


@query("round_columns", oracle=f"""
select l_orderkey, l_partkey, l_suppkey, l_linenumber,
       {_sround('l_extendedprice*(1-l_discount)', 2)} as net_price,
       {_sround(NET, 2)} as net_amount,
       {_sround('l_extendedprice*l_tax', 4)} as tax_amount
from lineitem
""")
def q_round_columns(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select(*LINE_KEY,
                     F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("net_price"),
                     F.round(net_amount(), 2).alias("net_amount"),
                     F.round(F.col("l_extendedprice") * F.col("l_tax"), 4).alias("tax_amount"))


# ------------------------------------------------------------------- joins

_DOC_COLS = ["doc_id", "lang", "source", "n_chars"]


def _docs_labels(spark, sf):
    return t(spark, sf, "documents").select(*_DOC_COLS), t(spark, sf, "labels")


_J = "select {k}, d.lang, d.source, d.n_chars, l.quality, l.toxic from documents d {how} labels l on d.doc_id = l.doc_id"


@query("join_inner", oracle=_J.format(k="d.doc_id", how="join"))
def q_join_inner(spark, sf):
    return equi_join(*_docs_labels(spark, sf), "doc_id", "inner")


@query("join_left", oracle=_J.format(k="d.doc_id", how="left join"))
def q_join_left(spark, sf):
    return equi_join(*_docs_labels(spark, sf), "doc_id", "left")


@query("join_right", oracle=_J.format(k="l.doc_id as doc_id", how="right join"))
def q_join_right(spark, sf):
    return equi_join(*_docs_labels(spark, sf), "doc_id", "right")


@query("join_outer", oracle=_J.format(k="coalesce(d.doc_id, l.doc_id) as doc_id", how="full join"))
def q_join_outer(spark, sf):
    return equi_join(*_docs_labels(spark, sf), "doc_id", "outer")


@query("join_semi", oracle="""
select doc_id, lang, source, n_chars from documents d
where exists (select 1 from labels l where l.doc_id = d.doc_id)
""")
def q_join_semi(spark, sf):
    return equi_join(*_docs_labels(spark, sf), "doc_id", "leftsemi")


@query("join_anti", oracle="""
select doc_id, lang, source, n_chars from documents d
where not exists (select 1 from labels l where l.doc_id = d.doc_id)
""")
def q_join_anti(spark, sf):
    return equi_join(*_docs_labels(spark, sf), "doc_id", "leftanti")


def _daily(spark, sf):
    od = (t(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day"))
          .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("order_value")))
    sd = (t(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day"))
          .agg(F.count(F.lit(1)).alias("n_lines")))
    return od, sd


_DAILY = """
with od as (select cast(o_orderdate as date) as day, count(*) as n_orders,
                   round(sum(o_totalprice), 2) as order_value from orders group by 1),
     sd as (select cast(l_shipdate as date) as day, count(*) as n_lines from lineitem group by 1)
select {k}, od.n_orders, od.order_value, sd.n_lines from od {how} sd on od.day = sd.day
"""


@query("join_right_daily", oracle=_DAILY.format(k="sd.day as day", how="right join"))
def q_join_right_daily(spark, sf):
    return equi_join(*_daily(spark, sf), "day", "right")


@query("join_outer_daily", oracle=_DAILY.format(k="coalesce(od.day, sd.day) as day", how="full join"))
def q_join_outer_daily(spark, sf):
    return equi_join(*_daily(spark, sf), "day", "outer")


# ------------------------------------------------------------ distinct/dedup


@query("distinct_rows", oracle="select distinct l_returnflag, l_linestatus from lineitem")
def q_distinct_rows(spark, sf):
    return distinct_rows(t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("dedup_by_key", oracle="""
select * from orders
qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1
""")
def q_dedup_by_key(spark, sf):
    """First order of every customer."""
    return dedup_by_key(t(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("dedup_by_category", oracle="""
select * from lineitem
qualify row_number() over (partition by l_returnflag
    order by l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate) = 1
""")
def q_dedup_by_category(spark, sf):
    """One line per return flag (a 3-value key: the hot-key case)."""
    return dedup_by_key(t(spark, sf, "lineitem"), ["l_returnflag"],
                        LINE_KEY + ["l_extendedprice", "l_shipdate"])


# ---------------------------------------------------------------- ordering


@query("limit_rows", oracle="""
select cast(least(10, count(*)) as bigint) as n_rows, cast(least(10, count(*)) as bigint) as n_matched
from orders
""")
def q_limit_rows(spark, sf):
    """Any 10 orders; checked by invariant (10 rows, all of them real orders)."""
    orders = t(spark, sf, "orders")
    some = limit_rows(orders, 10)
    # membership from the big side: the 10 sampled rows are broadcast (bounded by the
    # limit), orders is scanned once with no shuffle
    matched = orders.join(F.broadcast(some), orders.columns, "leftsemi")
    return some.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_matched", matched.agg(F.count(F.lit(1))).scalar())


@query("sort_desc", oracle="select o_orderkey, o_totalprice from orders")
def q_sort_desc(spark, sf):
    return sort_desc(t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"])


@query("top_k", oracle=f"""
select l_orderkey, l_partkey, l_suppkey, l_linenumber, round({NET}, 6) as net_amount
from lineitem
order by {NET} desc, l_orderkey, l_partkey, l_suppkey, l_linenumber limit 10
""")
def q_top_k(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("net", net_amount())
    best = top_k(li, 10, [F.desc("net")] + LINE_KEY)
    return best.select(*LINE_KEY, F.round("net", 6).alias("net_amount"))
