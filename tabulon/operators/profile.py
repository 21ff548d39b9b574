"""One-pass table profiling.

Every multi-column profile is a single ``agg`` over the table (partial aggregation
map-side, one tiny shuffle) whose one-row result is unpivoted in place with
``inline(array(struct ...))``. Nothing is collected per column, nothing loops over
columns with separate jobs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType, StringType

from tabulon.functions.scalar import is_missing
from tabulon.operators.columns import NUMERIC_TYPES, split_by_type


def _inline(df_one_row: DataFrame, structs: list[Column]) -> DataFrame:
    return df_one_row.select(F.inline(F.array(*structs)))


def _dtype(df: DataFrame, col: str):
    return df.schema[col].dataType


def _numeric_non_missing(df: DataFrame, col: str) -> DataFrame:
    x = F.col(col).cast("double")
    return df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))


def _finite(df: DataFrame, col: str) -> DataFrame:
    return _numeric_non_missing(df, col).where(F.abs("x") != F.lit(float("inf")))


# --------------------------------------------------------------------------- schema

def schema_table(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable, role, n_non_null) — one scan."""
    numeric, _ = split_by_type(df.schema)
    structs = []
    for i, f in enumerate(df.schema.fields):
        structs.append(F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"),
            F.lit("numeric" if f.name in numeric else "categorical").alias("role"),
            F.count(F.col(f"`{f.name}`")).alias("n_non_null"),
        ))
    return df.agg(F.array(*structs).alias("s")).select(F.inline("s"))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


# ------------------------------------------------------------------------- describe

def significant(x: Column, digits: int = 9) -> Column:
    """A double rounded to so many significant digits: sums of doubles differ in their
    last digits with the order of the rows."""
    return F.when(x.isNotNull(), F.format_string(f"%.{digits - 1}e", x).cast("double"))


#: Beyond this, squares and sums of doubles may overflow; the moments of a column that goes
#: there are taken of its values divided by a power of two.
_HUGE, _SCALE = 1e150, 2.0 ** 540


def _moment(f, x: Column) -> Column:
    """A mean or standard deviation that overflows only where its own value does."""
    return F.when(F.max(F.abs(x)) > _HUGE, f(x / _SCALE) * _SCALE).otherwise(f(x))


def describe_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Typed ``describe``: one row per column with count, mean, stddev, min, max.

    Numeric columns fill ``mean``, ``stddev`` (both to 9 significant digits),
    ``min_num, max_num``; NaN is missing in all of them and in the count, infinities
    are values. Text columns fill
    ``min_str, max_str`` (mean and stddev of text are NULL, as in Spark). Columns of
    other types are skipped, as Spark's ``describe`` does; a table of only those gives no
    rows.
    """
    if cols is None:
        cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, NUMERIC_TYPES + (StringType,))]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n bigint, mean double, stddev double, min_num double, "
                                               "max_num double, min_str string, max_str string")
    structs = []
    for c in cols:
        x = F.col(f"`{c}`")
        num = isinstance(_dtype(df, c), NUMERIC_TYPES)
        xd = F.nanvl(x.cast("double"), F.lit(None).cast("double")) if num else x
        null_d, null_s = F.lit(None).cast("double"), F.lit(None).cast("string")
        structs.append(F.struct(
            F.lit(c).alias("column_name"),
            F.count(xd).alias("n"),
            (significant(_moment(F.avg, xd)) if num else null_d).alias("mean"),
            (significant(_moment(F.stddev_samp, xd)) if num else null_d).alias("stddev"),
            (F.min(xd) if num else null_d).alias("min_num"),
            (F.max(xd) if num else null_d).alias("max_num"),
            (null_s if num else F.min(x).cast("string")).alias("min_str"),
            (null_s if num else F.max(x).cast("string")).alias("max_str"),
        ))
    return df.agg(F.array(*structs).alias("s")).select(F.inline("s"))


# -------------------------------------------------------------------- missing/distinct

def missing_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_missing): NULL, plus NaN in float columns; one pass."""
    structs = [F.struct(F.lit(f.name).alias("column_name"),
                        F.count_if(is_missing(f"`{f.name}`", f.dataType)).alias("n_missing"))
               for f in df.schema.fields]
    return df.agg(F.array(*structs).alias("s")).select(F.inline("s"))


def fingerprint(col: Column) -> Column:
    """128-bit fingerprint of a value (two independently seeded 64-bit hashes); NULL
    stays NULL. Distinct fingerprints equal distinct values except with probability
    about n^2 / 2^129 (1e-19 for ten billion distinct values)."""
    return F.when(col.isNotNull(), F.struct(F.xxhash64(col, F.lit(0x5EED1)).alias("a"),
                                            F.xxhash64(col, F.lit(0x5EED2)).alias("b")))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, *,
                    exact: bool = True, rsd: float = 0.01, by_fingerprint: bool = True) -> DataFrame:
    """(column_name, n_distinct) sorted by n_distinct desc; NULL is not counted.

    ``cols`` defaults to the categorical columns. Exact counting shuffles every
    distinct value once (after map-side de-duplication), as a 16-byte fingerprint (see
    ``fingerprint``); ``by_fingerprint=False`` shuffles the values themselves. ``exact=False`` uses HyperLogLog++
    (``approx_count_distinct``), which needs no per-value shuffle at all.
    """
    if cols is None:
        _, cols = split_by_type(df.schema)
    if not exact:
        fn = lambda c: F.approx_count_distinct(c, rsd)
    elif by_fingerprint:
        fn = lambda c: F.count_distinct(fingerprint(c))
    else:
        fn = lambda c: F.count_distinct(c)
    structs = [F.struct(F.lit(c).alias("column_name"),
                        fn(F.col(f"`{c}`")).alias("n_distinct")) for c in cols]
    out = df.agg(F.array(*structs).alias("s")).select(F.inline("s"))
    return out.orderBy(F.desc("n_distinct"), F.asc("column_name"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n, share) of one column; the total is the sum of the groups, whose
    exchange is reused, so the table is read once."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.round(F.try_divide(F.col("n"), total), 6))


# ------------------------------------------------------------------- distributions

def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram of the finite values: (bin, lo, hi, n), empty bins included;
    NULL, NaN and infinities are left out.

    Edges come from one min/max pass (a single row to the driver); the maximum
    lands in the last bin.
    The count is a ``groupBy(bin)`` with map-side partial counts.
    """
    base = _finite(df, col)
    st = base.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()  # one row
    if st["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    lo = F.lit(st["lo"])
    wide = st["hi"] - st["lo"] == float("inf")  # the range is beyond the largest double: work on halves
    width = F.lit(st["hi"] / bins - st["lo"] / bins if wide else (st["hi"] - st["lo"]) / bins if st["hi"] > st["lo"] else 1.0)
    place = (F.col("x") / 2 - lo / 2) / (width / 2) if wide else (F.col("x") - lo) / width
    b = F.least(F.floor(place).cast("int"), F.lit(bins - 1))

    def edge(k: Column) -> Column:
        return lo * (1 - k / bins) + F.lit(st["hi"]) * (k / bins) if wide else lo + k * width

    counts = base.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = grid.join(F.broadcast(counts), "bin", "left")  # both sides have <= bins rows
    return out.select(
        "bin",
        F.round(edge(F.col("bin")), 6).alias("lo"),
        F.round(edge(F.col("bin") + 1), 6).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
    )


def kde_density(df: DataFrame, col: str, gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid: (i, x, density).

    Bandwidth by Scott's rule, h = stddev_samp * n^(-1/5); the grid spans
    [min - cut*h, max + cut*h] (the usual plotting defaults: 200 points, cut 3).
    Exact: the kernel sums of all grid points are one aggregate over the scan, so a
    task forwards ``gridsize`` numbers whatever it reads. Infinities are left out.
    """
    spark = df.sparkSession
    base = _finite(df, col)
    st = base.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                  F.min("x").alias("lo"), F.max("x").alias("hi")).first()  # one row
    if not st["n"] or not st["sd"]:
        return spark.createDataFrame([], "i int, x double, density double")
    n = float(st["n"])
    h_v = st["sd"] * n ** -0.2
    g_lo_v = st["lo"] - cut * h_v
    step_v = ((st["hi"] + cut * h_v) - g_lo_v) / (gridsize - 1)

    # one aggregate over the scan: a sum for every grid point, combined map-side
    points = [g_lo_v + i * step_v for i in range(gridsize)]
    sums = base.selectExpr("array(" + ", ".join(
        f"sum(exp(-0.5D * pow(({p!r}D - x) / {h_v!r}D, 2)))" for p in points) + ") as s")
    norm = F.lit(n * h_v * math.sqrt(2 * math.pi))
    return sums.select(F.posexplode("s").alias("i", "s")).select(
        F.col("i").cast("int").alias("i"),
        F.round(F.lit(g_lo_v) + F.col("i") * F.lit(step_v), 4).alias("x"),
        F.round(F.col("s") / norm, 12).alias("density"),
    )


def kde_binned(df: DataFrame, col: str, gridsize: int = 200, cut: float = 3.0, cells_a_bandwidth: int = 32) -> DataFrame:
    """The curve of ``kde_density`` from a table of counts: (i, x, density, max_error).

    Every value is divided between the two edges of its cell by how near it lies to each
    (linear binning), with ``cells_a_bandwidth`` = c cells to a bandwidth h; the kernel is then
    summed over cells in place of rows. A row costs one addition, and the kernel
    is evaluated for cells x grid points. Kernel values between edges are so interpolated
    on a line, and as the kernel's second derivative is at most 1 / h^2, no density is off by
    more than ``max_error`` = 1 / (8 c^2 h sqrt(2 pi)), whatever the data.

    Cells are rows of a table, of which only those with values exist: their number
    grows with range / h, at most with the 0.7th power of the rows. Infinities, NaN and
    NULL are left out; fewer than two different values give no rows.
    """
    spark = df.sparkSession
    base = _finite(df, col)
    st = base.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                  F.min("x").alias("lo"), F.max("x").alias("hi")).first()  # one row
    if not st["n"] or not st["sd"]:
        return spark.createDataFrame([], "i int, x double, density double, max_error double")
    n, lo = float(st["n"]), st["lo"]
    h = st["sd"] * n ** -0.2
    width = h / cells_a_bandwidth
    g_lo = lo - cut * h
    step = ((st["hi"] + cut * h) - g_lo) / (gridsize - 1)

    place = (F.col("x") - F.lit(lo)) / F.lit(width)
    cells = (base.select(F.floor(place).alias("cell"), place.alias("p"))
             .groupBy("cell").agg(F.count(F.lit(1)).alias("c"), F.sum(F.col("p") - F.col("cell")).alias("upper")))
    edges = cells.selectExpr(f"{lo!r}D + cell * {width!r}D as e", f"{lo!r}D + (cell + 1) * {width!r}D as f",
                             "c - upper as lower", "upper")
    points = [g_lo + i * step for i in range(gridsize)]
    sums = edges.selectExpr("array(" + ", ".join(
        f"sum(lower * exp(-0.5D * pow(({p!r}D - e) / {h!r}D, 2)) + upper * exp(-0.5D * pow(({p!r}D - f) / {h!r}D, 2)))"
        for p in points) + ") as s")
    norm = h * math.sqrt(2 * math.pi)
    return sums.select(F.posexplode("s").alias("i", "s")).select(
        F.col("i").cast("int").alias("i"),
        F.round(F.lit(g_lo) + F.col("i") * F.lit(step), 4).alias("x"),
        F.round(F.col("s") / F.lit(n * norm), 12).alias("density"),
        F.round(F.lit(1 / (8 * cells_a_bandwidth ** 2 * norm)), 12).alias("max_error"),
    )


# ------------------------------------------------------------------- correlations

def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pair_correlations(df: DataFrame, pairs: list[tuple[str, str]], cols: list[str]) -> DataFrame:
    """One-row DataFrame with column ``c{k}`` = corr of ``pairs[k]``.

    Each pair keeps the rows in which both are present (NULL and NaN are missing, as
    in pandas); one pass.
    """
    base = df.select(*[F.nanvl(F.col(_ident(c)).cast("double"), F.lit(None).cast("double")).alias(f"v{i}")
                       for i, c in enumerate(cols)])
    idx = {c: i for i, c in enumerate(cols)}
    return base.selectExpr(*[f"corr(v{idx[a]}, v{idx[b]}) as c{k}" for k, (a, b) in enumerate(pairs)])


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair (col_a, col_b, corr), 6 places.

    Each pair keeps the rows in which both are present (NULL and NaN are missing, as in
    pandas); NULL where a side does not vary, or has an infinity or squares beyond the double.

    One scan. A task multiplies blocks of rows with the blocks' presence masks, which gives
    the counts, means and centred sums of all pairs at once, and merges them (the pairwise
    update of variances); what it hands on is a row for each column. Those rows are merged
    by column, in two steps, so no task gets the rows of all tasks.
    """
    cols = list(cols)
    width = len(cols)
    base = df.select(*[F.col(_ident(c)).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    names = ["n", "mx", "my", "sxx", "syy", "sxy"]

    def block(x):
        """The six matrices of one block: of column i, over the rows that have column j too."""
        there = ~np.isnan(x)
        m = there.astype(float)
        counts = np.maximum(m.sum(axis=0), 1)
        full = np.where(there, x, 0.0)
        least, most = (f(axis=0) for f in (np.where(there, x, np.inf).min, np.where(there, x, -np.inf).max))
        # a column of one value is centred to zeros exactly
        shift = np.where(least == most, least, full.sum(axis=0) / counts)
        d = np.where(there, x - shift, 0.0)
        n = m.T @ m
        some = np.maximum(n, 1)
        a = d.T @ m
        mx = np.where(n > 0, a / some + shift[:, None], 0.0)
        sxx = (d * d).T @ m - a * a / some
        sxy = d.T @ d - a * a.T / some
        return [n, mx, mx.T, np.maximum(sxx, 0), np.maximum(sxx, 0).T, sxy]

    def merge(p, q):
        n = p[0] + q[0]
        share = np.where(n > 0, q[0] / np.maximum(n, 1), 0.0)
        dx, dy, both = q[1] - p[1], q[2] - p[2], p[0] * share
        dx, dy = (np.where((p[0] > 0) & (q[0] > 0), d, 0.0) for d in (dx, dy))
        mx = np.where(p[0] > 0, p[1] + dx * share, q[1])
        my = np.where(p[0] > 0, p[2] + dy * share, q[2])
        return [n, mx, my, p[3] + q[3] + dx * dx * both, p[4] + q[4] + dy * dy * both, p[5] + q[5] + dx * dy * both]

    def partial(batches):
        total = None
        with np.errstate(all="ignore"):
            for batch in batches:
                if batch.num_rows:
                    x = np.stack([c.cast("float64").fill_null(float("nan")).to_numpy(zero_copy_only=False)
                                  for c in batch.columns], axis=1)
                    total = block(x) if total is None else merge(total, block(x))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32())] + [pa.array(list(t)) for t in total],
                                             names=["i", *names])

    def merged(group):
        total = None
        with np.errstate(all="ignore"):
            for k in range(group.num_rows):
                row = [np.array(group[x][k].as_py()) for x in names]
                total = row if total is None else merge(total, row)
        return total

    def halfway(group: pa.Table) -> pa.Table:
        return pa.table({"i": group["i"][:1]} | {x: pa.array([t]) for x, t in zip(names, merged(group))})

    def last(group: pa.Table) -> pa.Table:
        n, _, _, sxx, syy, sxy = merged(group)
        with np.errstate(all="ignore"):
            r = sxy / (np.sqrt(sxx) * np.sqrt(syy))
        r = np.where((n > 1) & np.isfinite(r), np.clip(r, -1, 1), np.nan)
        i = group["i"][0].as_py()
        return pa.table({"col_a": pa.array([cols[i]] * width), "col_b": pa.array(cols),
                         "corr": pa.array(r, pa.float64(), from_pandas=True)})

    arrays = ", ".join(f"{x} array<double>" for x in names)
    rows = base.mapInArrow(partial, f"i int, {arrays}").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    rows = rows.groupBy("i", "part").applyInArrow(halfway, f"i int, {arrays}")
    out = rows.groupBy("i").applyInArrow(last, "col_a string, col_b string, corr double")
    return out.withColumn("corr", F.round("corr", 6))


def target_correlation(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(column_name, corr) with the target, highest first; the target itself is 1.0."""
    cols = list(cols)
    if target not in cols:
        cols.append(target)
    agg = _pair_correlations(df, [(c, target) for c in cols], cols)
    items = [f"{_text(c)}, round(c{k}, 6)" for k, c in enumerate(cols)]
    out = agg.selectExpr(f"stack({len(items)}, {', '.join(items)}) as (column_name, corr)")
    return out.orderBy(F.desc("corr"), F.asc("column_name"))


# ------------------------------------------------------------------------- median

def _exact_type(df: DataFrame, col: str) -> str:
    """The type in which a column's values are compared: whole numbers and decimals as decimals
    of their own scale, so none is rounded to a double."""
    dtype = _dtype(df, col)
    if isinstance(dtype, DecimalType):
        return dtype.simpleString()
    return "decimal(20, 0)" if isinstance(dtype, IntegralType) else "double"


def exact_medians(df: DataFrame, cols: Sequence[str], buckets: int = 4096) -> dict[str, float | Decimal | None]:
    """Exact median of every column (mean of the two middle values for even n), NULL and
    NaN skipped; infinities are values. Of whole numbers and decimals it is a decimal.

    Spark's ``median`` buffers every distinct value of a group in one task. Here the two
    middle ranks of all columns are narrowed down together: a round is one filtered
    scan and a ``groupBy(column, rank, bucket)``, and the interval of a rank shrinks to
    the least and largest value of the bucket that holds it, until they are one value.
    The bucket is found by running counts on the cluster; a row for each column and
    rank reaches the driver. Both ends of an interval are values of the column and
    fall in different buckets, so every round gets nearer; a bucket's number is a double, but
    the values are compared and kept in their own type.
    """
    names = [f"v{i}" for i in range(len(cols))]
    types = [_exact_type(df, c) for c in cols]
    floats = [ty == "double" for ty in types]
    base = df.select(*[(F.nanvl(F.col(_ident(c)).cast("double"), F.lit(None).cast("double")) if fl
                        else F.col(_ident(c)).cast(ty)).alias(v) for c, v, ty, fl in zip(cols, names, types, floats)])
    inf = float("inf")

    def finite(v, fl):
        return F.abs(v) != inf if fl else F.col(v).isNotNull()

    first = base.agg(*[f(F.when(finite(v, fl), F.col(v))).alias(f"{k}{v}") for v, fl in zip(names, floats)
                       for k, f in (("lo", F.min), ("hi", F.max))],
                     *[F.count(v).alias(f"n{v}") for v in names],
                     *[(F.count_if(F.col(v) == -inf) if fl else F.lit(0)).alias(f"under{v}") for v, fl in zip(names, floats)],
                     *[F.count(F.when(finite(v, fl), 1)).alias(f"fin{v}") for v, fl in zip(names, floats)]).first()
    done: dict[tuple[int, int], float | Decimal] = {}
    open_: dict[tuple[int, int], tuple] = {}  # (column, rank) -> lo, hi, rows below lo
    for i, v in enumerate(names):
        n, under, fin = first[f"n{v}"], first[f"under{v}"], first[f"fin{v}"]
        for k in {(n - 1) // 2, n // 2} if n else ():
            if k < under:
                done[i, k] = -inf
            elif k >= under + fin:
                done[i, k] = inf
            else:
                open_[i, k] = first[f"lo{v}"], first[f"hi{v}"], under
    while True:
        for key in [key for key, (lo, hi, _) in open_.items() if lo == hi]:
            done[key] = open_.pop(key)[0]
        if not open_:
            break
        found = None
        for exact in (True, False):  # doubles and decimals do not share a column
            own = {key: x for key, x in open_.items() if floats[key[0]] != exact}
            if not own:
                continue
            scale = max((int(types[i].rstrip(")").split(",")[1]) for i, _ in own), default=0) if exact else 0
            kind = f"decimal(38, {scale})" if exact else "double"
            parts, inside = [], F.lit(False)
            for (i, k), (lo, hi, _) in own.items():
                x = F.col(names[i])
                if exact:
                    share = (x - F.lit(lo).cast(types[i])).cast("double") / float(hi - lo)
                else:  # halves, so that the span of the largest doubles is not infinite
                    share = (x / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2) if hi / 2 > lo / 2 else (x > lo).cast("double")
                here = x.between(F.lit(lo).cast(types[i]), F.lit(hi).cast(types[i]))
                # only the greatest value is in the last bucket, so both ends never share one
                b = F.when(x >= F.lit(hi).cast(types[i]), F.lit(buckets)).otherwise(
                    F.least(F.floor(share * buckets), F.lit(buckets - 1))).cast("int")
                parts.append(F.when(here, F.struct(F.lit(i).alias("i"), F.lit(k).cast("long").alias("k"), b.alias("b"),
                                                   x.cast(kind).alias("x"))))
                inside = inside | F.coalesce(here, F.lit(False))
            rows = (base.where(inside).select(F.explode(F.array_compact(F.array(*parts))).alias("p")).select("p.*")
                    .groupBy("i", "k", "b").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")))
            below = df.sparkSession.createDataFrame([(i, k, x[2]) for (i, k), x in own.items()], "i int, k long, below long")
            upto = Window.partitionBy("i", "k").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)  # at most buckets rows
            hit = (rows.join(F.broadcast(below), ["i", "k"]).withColumn("upto", F.col("below") + F.sum("n").over(upto))
                   .where(F.col("upto") > F.col("k")).groupBy("i", "k")
                   .agg(F.min_by(F.struct("lo", "hi", (F.col("upto") - F.col("n")).alias("below")), "b").alias("at")))
            found = (found or []) + hit.collect()
        for r in found:
            at = r["at"]
            open_[r["i"], r["k"]] = at["lo"], at["hi"], at["below"]
    out = {}
    for i, c in enumerate(cols):
        vals = [v for (j, _), v in done.items() if j == i]
        out[c] = sum(vals) / len(vals) if vals else None
    return out


def exact_median(df: DataFrame, col: str, buckets: int = 4096) -> float | Decimal | None:
    """``exact_medians`` of one column."""
    return exact_medians(df, [col], buckets)[col]


def impute_median(df: DataFrame, cols: Sequence[str], buckets: int = 4096,
                  exact: bool = True, relative_error: float = 0.001) -> DataFrame:
    """Replace NULL/NaN in ``cols`` by the column's median. A column of whole numbers keeps its
    type where the median is one, and becomes a decimal with one place where it lies
    between two; a decimal column gets a place more in that case.

    ``exact=True``: the exact median by distributed selection (a few scans).
    ``exact=False``: MLlib's ``Imputer(strategy='median')`` — one pass of
    Greenwald-Khanna sketches for all columns, rank error <= ``relative_error``.
    """
    if not exact:
        from pyspark.ml.feature import Imputer
        cast = df.withColumns({c: F.col(f"`{c}`").cast("double") for c in cols})
        imp = Imputer(strategy="median", inputCols=list(cols), outputCols=list(cols),
                      relativeError=relative_error)
        return imp.fit(cast).transform(cast)
    fills = {}
    for c, m in exact_medians(df, cols, buckets).items():
        x = F.col(f"`{c}`")
        miss = x.isNull() | (F.isnan(x) if isinstance(_dtype(df, c), (DoubleType, FloatType)) else F.lit(False))
        if isinstance(m, Decimal):
            whole = isinstance(_dtype(df, c), IntegralType)
            places = 0 if whole else _dtype(df, c).scale
            own = _dtype(df, c).simpleString() if m == round(m, places) else f"decimal({21 if whole else min(38, _dtype(df, c).precision + 1)}, {places + 1})"
            fills[c] = F.when(miss, F.lit(m).cast(own)).otherwise(x.cast(own))
        else:
            fills[c] = F.when(miss, F.lit(m)).otherwise(x) if m is not None else x
    return df.withColumns(fills)


# ----------------------------------------------------------------- column removal

def column_profile(df: DataFrame, categorical: Sequence[str] | None = None,
                   by_fingerprint: bool = True) -> DataFrame:
    """(column_name, n_rows, n_missing, n_distinct) in one pass; n_distinct only for
    categorical columns (NULL for the rest); ``by_fingerprint`` as in ``distinct_counts``."""
    if categorical is None:
        _, categorical = split_by_type(df.schema)
    cat = set(categorical)
    structs = []
    for f in df.schema.fields:
        x = F.col(f"`{f.name}`")
        structs.append(F.struct(
            F.lit(f.name).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(is_missing(f"`{f.name}`", f.dataType)).alias("n_missing"),
            ((F.count_distinct(fingerprint(x)) if by_fingerprint else F.count_distinct(x))
             if f.name in cat else F.lit(None).cast("bigint")).alias("n_distinct"),
        ))
    return df.agg(F.array(*structs).alias("s")).select(F.inline("s"))


def flag_uninformative(profile: DataFrame, max_null_rate: float = 0.95,
                       max_distinct_ratio: float = 0.9) -> DataFrame:
    """Adds ``drop``: all/mostly missing, or (categorical) nearly one value per row."""
    null_rate = F.try_divide(F.col("n_missing"), F.col("n_rows"))
    ratio = F.try_divide(F.col("n_distinct"), F.col("n_rows") - F.col("n_missing"))
    return profile.withColumn(
        "drop", (null_rate >= F.lit(max_null_rate)) | F.coalesce(ratio > F.lit(max_distinct_ratio), F.lit(False)))


def drop_uninformative(df: DataFrame, max_null_rate: float = 0.95, max_distinct_ratio: float = 0.9,
                       keep: Sequence[str] = (), by_fingerprint: bool = True) -> tuple[DataFrame, DataFrame]:
    """(profile with decisions, table without the flagged columns).

    The profile is one row per column, so deciding on the driver is bounded.
    """
    prof = flag_uninformative(column_profile(df, by_fingerprint=by_fingerprint), max_null_rate,
                              max_distinct_ratio)
    rows = prof.collect()
    gone = [r["column_name"] for r in rows if r["drop"] and r["column_name"] not in keep]
    decided = df.sparkSession.createDataFrame(rows, schema=prof.schema)
    return decided, df.drop(*gone)
