"""Profiling queries: schema, describe, shape, missing, distinct, frequencies,
histogram, density, correlations, median imputation, column removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.catalog.registry import query, t
from tabulon.functions.scalar import net_amount, null_when
from tabulon.operators import profile as P
from tabulon.operators.features import dummies

# Driver-table column lists used to write the oracle SQL (types as Spark reads them).
LINEITEM_COLS = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]
_NUMERIC = {"bigint", "int", "double"}
NET = "l_extendedprice*(1-l_discount)*(1+l_tax)"


def _union(parts):
    return "\nunion all\n".join(parts)


# ------------------------------------------------------------------- schema

@query("schema_table", oracle=_union([
    f"select {i} as position, '{c}' as column_name, '{ty}' as data_type, true as nullable, "
    f"'{'numeric' if ty in _NUMERIC else 'categorical'}' as role, count({c}) as n_non_null from lineitem"
    for i, (c, ty) in enumerate(LINEITEM_COLS)]))
def q_schema_table(spark, sf):
    return P.schema_table(t(spark, sf, "lineitem"))


@query("table_shape", oracle=f"select count(*) as n_rows, {len(LINEITEM_COLS)} as n_cols from lineitem")
def q_table_shape(spark, sf):
    return P.table_shape(t(spark, sf, "lineitem"))


def _describe_sql(c, ty):
    if ty in _NUMERIC:
        x = f"cast({c} as double)"
        return (f"select '{c}' as column_name, count({c}) as n, cast(printf('%.8e', avg({x})) as double) as mean, "
                f"cast(printf('%.8e', stddev_samp({x})) as double) as stddev, min({x}) as min_num, max({x}) as max_num, "
                f"cast(null as varchar) as min_str, cast(null as varchar) as max_str from lineitem")
    return (f"select '{c}' as column_name, count({c}) as n, cast(null as double) as mean, "
            f"cast(null as double) as stddev, cast(null as double) as min_num, cast(null as double) as max_num, "
            f"min({c}) as min_str, max({c}) as max_str from lineitem")


@query("describe_columns", oracle=_union([_describe_sql(c, ty) for c, ty in LINEITEM_COLS
                                          if ty != "timestamp_ntz"]))
def q_describe_columns(spark, sf):
    return P.describe_columns(t(spark, sf, "lineitem"))


# ---------------------------------------------------------- missing/distinct

def _customer_with_gaps(spark, sf):
    """customer plus a NULL-holed and a NaN-holed copy of the balance."""
    c = t(spark, sf, "customer")
    neg = F.col("c_acctbal") < 0
    return c.withColumns({
        "c_acctbal2": null_when(neg, "c_acctbal"),
        "c_acctbal_nan": F.when(neg, F.lit(float("nan"))).otherwise(F.col("c_acctbal")),
    })


_CUST_GAPS = """(select *, case when c_acctbal < 0 then null else c_acctbal end as c_acctbal2,
       case when c_acctbal < 0 then 'NaN'::double else c_acctbal end as c_acctbal_nan from customer)"""


@query("missing_counts", oracle=_union([
    f"select '{c}' as column_name, cast(count_if({c} is null{' or isnan(' + c + ')' if fl else ''}) as bigint) "
    f"as n_missing from {_CUST_GAPS}"
    for c, fl in [("c_custkey", False), ("c_name", False), ("c_nationkey", False), ("c_acctbal", True),
                  ("c_mktsegment", False), ("c_acctbal2", True), ("c_acctbal_nan", True)]]))
def q_missing_counts(spark, sf):
    return P.missing_counts(_customer_with_gaps(spark, sf))


@query("distinct_counts", oracle=_union([
    f"select '{c}' as column_name, count(distinct {c}) as n_distinct from documents"
    for c in ["text", "lang", "source"]]))
def q_distinct_counts(spark, sf):
    """Distinct values of every categorical column of ``documents`` (whole texts)."""
    return P.distinct_counts(t(spark, sf, "documents"))


@query("value_counts", oracle="""
select l_returnflag, count(*) as n, round(count(*) / (select count(*) from lineitem), 6) as share
from lineitem group by l_returnflag
""")
def q_value_counts(spark, sf):
    return P.value_counts(t(spark, sf, "lineitem"), "l_returnflag")


# ------------------------------------------------------------ distributions

@query("histogram", oracle="""
with s as (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders),
     w as (select lo, case when hi > lo then (hi - lo) / 20 else 1.0 end as width from s),
     c as (select least(cast(floor((o_totalprice - w.lo) / w.width) as integer), 19) as bin, count(*) as n
           from orders, w group by 1),
     g as (select cast(range as integer) as bin from range(20))
select g.bin, round(w.lo + g.bin * w.width, 6) as lo, round(w.lo + (g.bin + 1) * w.width, 6) as hi,
       cast(coalesce(c.n, 0) as bigint) as n
from g cross join w left join c on g.bin = c.bin
""")
def q_histogram(spark, sf):
    return P.histogram(t(spark, sf, "orders"), "o_totalprice", bins=20)


@query("kde_density", oracle="""
with b as (select cast(o_totalprice as double) as x from orders where o_totalprice is not null and not isnan(o_totalprice)),
     st as (select cast(count(*) as double) as n, stddev_samp(x) * pow(cast(count(*) as double), -0.2) as h,
                   min(x) as lo, max(x) as hi from b),
     p as (select n, h, lo - 3.0 * h as g_lo, ((hi + 3.0 * h) - (lo - 3.0 * h)) / 199 as step from st),
     w as (select x, cast(count(*) as double) as w from b group by x),
     g as (select cast(range as integer) as i from range(200))
select g.i, round(p.g_lo + g.i * p.step, 4) as x,
       round(sum(w.w * exp(-0.5 * pow((p.g_lo + g.i * p.step - w.x) / p.h, 2))) / (p.n * p.h * sqrt(2 * pi())), 12) as density
from g, p, w
group by g.i, p.g_lo, p.step, p.n, p.h
""")
def q_kde_density(spark, sf):
    return P.kde_density(t(spark, sf, "orders"), "o_totalprice", gridsize=200, cut=3.0)


@query("kde_binned", oracle="""
with b as (select l_extendedprice as x from lineitem where l_extendedprice is not null and not isnan(l_extendedprice)),
     st as (select cast(count(*) as double) as n, stddev_samp(x) * pow(cast(count(*) as double), -0.2) as h,
                   min(x) as lo, max(x) as hi from b),
     p as (select n, h, lo, h / 32 as width, lo - 3.0 * h as g_lo, ((hi + 3.0 * h) - (lo - 3.0 * h)) / 199 as step from st),
     c as (select floor((x - lo) / width) as cell, (x - lo) / width - floor((x - lo) / width) as upper from b, p),
     w as (select cell, 1 - upper as weight from c union all select cell + 1, upper from c),
     e as (select cell, sum(weight) as weight from w group by cell),
     g as (select cast(range as integer) as i from range(200))
select g.i, round(p.g_lo + g.i * p.step, 4) as x,
       round(sum(e.weight * exp(-0.5 * pow((p.g_lo + g.i * p.step - (p.lo + e.cell * p.width)) / p.h, 2)))
             / (p.n * p.h * sqrt(2 * pi())), 12) as density,
       round(1 / (8 * 32 * 32 * p.h * sqrt(2 * pi())), 12) as max_error
from g, p, e
group by g.i, p.g_lo, p.step, p.n, p.h, p.lo, p.width
""")
def q_kde_binned(spark, sf):
    return P.kde_binned(t(spark, sf, "lineitem"), "l_extendedprice", gridsize=200, cut=3.0)


@query("kde_binned_error", oracle="select 200 as points, 200 as within, true as cheaper_is_close")
def q_kde_binned_error(spark, sf):
    """The binned curve against the exact one, point by point: all lie within the stated bound,
    and the greatest error is below a thousandth of the greatest density."""
    orders = t(spark, sf, "orders")
    exact = P.kde_density(orders, "o_totalprice").select("i", F.col("density").alias("exact"))
    both = P.kde_binned(orders, "o_totalprice").join(exact, "i")
    off = F.abs(F.col("density") - F.col("exact"))
    return both.agg(F.count(F.lit(1)).cast("int").alias("points"),
                    F.count_if(off <= F.col("max_error") + 2e-12).cast("int").alias("within"),
                    (F.max(off) < 0.001 * F.max("exact")).alias("cheaper_is_close"))


# ------------------------------------------------------------- correlations

ENCODED_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_amount",
                "l_returnflag_N", "l_returnflag_R", "l_linestatus_O"]
_ENC = f"""(select l_quantity, l_extendedprice, l_discount, l_tax, {NET} as net_amount,
       cast(l_returnflag = 'N' as integer) as l_returnflag_N, cast(l_returnflag = 'R' as integer) as l_returnflag_R,
       cast(l_linestatus = 'O' as integer) as l_linestatus_O from lineitem)"""


def _encoded_lineitem(spark, sf):
    li = t(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                         "l_returnflag", "l_linestatus", net_amount().alias("net_amount"))
    return dummies(li, ["l_returnflag", "l_linestatus"], drop_first=True)


@query("correlation_matrix", oracle=_union([
    f"select '{a}' as col_a, '{b}' as col_b, round(corr(cast({a} as double), cast({b} as double)), 6) as corr from {_ENC}"
    for a in ENCODED_COLS for b in ENCODED_COLS]))
def q_correlation_matrix(spark, sf):
    return P.correlation_matrix(_encoded_lineitem(spark, sf), ENCODED_COLS)


@query("target_correlation", oracle=_union([
    f"select '{a}' as column_name, round(corr(cast({a} as double), net_amount), 6) as corr from {_ENC}"
    for a in ENCODED_COLS]))
def q_target_correlation(spark, sf):
    return P.target_correlation(_encoded_lineitem(spark, sf), ENCODED_COLS, "net_amount")


# ----------------------------------------------------------- imputation

@query("impute_median", oracle=f"""
select c_custkey, round(coalesce(c_acctbal2, (select median(c_acctbal2) from {_CUST_GAPS})), 6) as c_acctbal2
from {_CUST_GAPS}
""")
def q_impute_median(spark, sf):
    df = _customer_with_gaps(spark, sf).select("c_custkey", "c_acctbal2")
    out = P.impute_median(df, ["c_acctbal2"])
    return out.select("c_custkey", F.round("c_acctbal2", 6).alias("c_acctbal2"))


@query("median_exact", oracle="""
select round(median(l_extendedprice), 6) as median_price, round(median(l_quantity), 6) as median_qty from lineitem
""")
def q_median_exact(spark, sf):
    """Exact medians of two lineitem columns by distributed selection."""
    li = t(spark, sf, "lineitem")
    m1, m2 = P.exact_medians(li, ["l_extendedprice", "l_quantity"]).values()
    return li.agg(F.count(F.lit(1)).alias("n")).select(
        F.round(F.lit(m1), 6).alias("median_price"), F.round(F.lit(m2), 6).alias("median_qty"))


# ---------------------------------------------------------- column removal

_DOCS_NOTE = "(select *, cast(null as double) as note from documents)"


@query("drop_uninformative", oracle=_union([
    f"select '{c}' as column_name, count(*) as n_rows, cast(count_if({c} is null{' or isnan(' + c + ')' if c == 'note' else ''}) as bigint) as n_missing, "
    + (f"count(distinct {c})" if cat else "cast(null as bigint)") + " as n_distinct, "
    + (f"(count_if({c} is null{' or isnan(' + c + ')' if c == 'note' else ''}) / count(*) >= 0.95) or "
       + (f"coalesce(count(distinct {c}) / (count(*) - count_if({c} is null)) > 0.9, false)" if cat else "false"))
    + f" as drop from {_DOCS_NOTE}"
    for c, cat in [("doc_id", False), ("text", True), ("lang", True), ("source", True), ("n_chars", False),
                   ("note", False)]]))
def q_drop_uninformative(spark, sf):
    """Profile of ``documents`` (+ an all-NULL column) with the drop decision:
    the all-NULL column and the near-unique ``text`` go."""
    docs = t(spark, sf, "documents").withColumn("note", F.lit(None).cast("double"))
    decided, _kept = P.drop_uninformative(docs)
    return decided


# ------------------------------------------------------------------ hard values

# Columns derived from orders by the key: NULL and NaN, infinities, a decimal, a short, numbers
# at both ends of the double, and whole numbers that no double holds.
_HARD = {
    "gaps": ("case when o_orderkey % 7 = 0 then null when o_orderkey % 11 = 0 then cast('NaN' as double) else o_totalprice end", "double"),
    "cents": ("cast(o_totalprice as decimal(18, 2))", "decimal"),
    "small": ("cast(o_orderkey % 100 as smallint)", "smallint"),
    "huge": ("case when o_orderkey % 2 = 0 then 1e308 else -1e308 end", "double"),
    "same": ("cast(1e308 as double)", "double"),
    "tiny": ("(o_orderkey % 5 + 1) * 1e-300", "double"),
    "big": ("9007199254740993 + 2 * (o_orderkey % 9)", "bigint"),
}
_HARD_SQL = "(select o_orderkey, " + ", ".join(f"{sql} as {c}" for c, (sql, _) in _HARD.items()) + " from orders)"


def hard_orders(spark, sf):
    """orders as derived columns of hard values."""
    return t(spark, sf, "orders").selectExpr("o_orderkey", *[f"{sql} as {c}" for c, (sql, _) in _HARD.items()])


def _hard_describe(c):
    x = f"(case when isnan(cast({c} as double)) then null else cast({c} as double) end)"
    # halves of a power of two, so that sums and squares of the largest doubles are finite
    up, down = ("* pow(2.0, 540)", "/ pow(2.0, 540)") if c in ("huge", "same") else ("", "")
    return (f"select '{c}' as column_name, count({x}) as n, cast(printf('%.8e', avg({x} {down}) {up}) as double) as mean, "
            f"cast(printf('%.8e', stddev_samp({x} {down}) {up}) as double) as stddev, min({x}) as min_num, max({x}) as max_num, "
            f"cast(null as varchar) as min_str, cast(null as varchar) as max_str from {_HARD_SQL}")


#: Not the balanced column, whose mean is what rounding leaves, nor the one whose spread is in
#: the last places of a double.
_HARD_DESCRIBED = [c for c in _HARD if c not in ("huge", "big")]


@query("describe_hard", oracle=_union([_hard_describe(c) for c in _HARD_DESCRIBED]))
def q_describe_hard(spark, sf):
    """Summary of columns with NULL, NaN, decimals, shorts, 1e308 and 1e-300."""
    return P.describe_columns(hard_orders(spark, sf), _HARD_DESCRIBED)


@query("histogram_hard", oracle=f"""
with c as (select case when huge > 0 then 3 else 0 end as bin, count(*) as n from {_HARD_SQL} group by 1)
select b as bin, (b - 2) * 5e307 as lo, (b - 1) * 5e307 as hi, coalesce(n, 0) as n
from (values (0), (1), (2), (3)) g(b) left join c on c.bin = b
""")
def q_histogram_hard(spark, sf):
    """Four bins over a range wider than the largest double."""
    return P.histogram(hard_orders(spark, sf), "huge", 4)


@query("median_hard", oracle=f"""
select o_orderkey, coalesce(case when isnan(gaps) then null else gaps end,
                            (select median(gaps) from {_HARD_SQL} where not isnan(gaps))) as gaps,
       coalesce(case when o_orderkey % 4 = 0 then null else big end,
                (select quantile_disc(big, 0.5) from {_HARD_SQL} where o_orderkey % 4 != 0)) as big
from {_HARD_SQL}
""")
def q_median_hard(spark, sf):
    """Median imputation of a column with NULL and NaN, and of longs beyond 2**53."""
    df = hard_orders(spark, sf).selectExpr("o_orderkey", "gaps", "case when o_orderkey % 4 = 0 then null else big end as big")
    return P.impute_median(df, ["gaps", "big"])


def _near(c):
    """As a double; large longs less a constant, so that squares keep their last places."""
    return f"cast({c} as double) - 9007199254740992.0" if c == "big" else f"cast({c} as double)"


@query("correlation_hard", oracle=_union([
    f"select '{a}' as col_a, '{b}' as col_b, round(corr(a, b), 6) as corr from (select {_near(a)} as a, "
    f"{_near(b)} as b from {_HARD_SQL}) where not isnan(a) and not isnan(b)"
    for a in ("gaps", "cents", "small", "big") for b in ("gaps", "cents", "small", "big")]))
def q_correlation_hard(spark, sf):
    """Correlations over each pair's complete rows, with NULL, NaN, decimals and large longs."""
    return P.correlation_matrix(hard_orders(spark, sf), ["gaps", "cents", "small", "big"])
