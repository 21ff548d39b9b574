"""Quality rules by robust multivariate outliers.

Statistics of every text become a short vector on scales where clean texts look normal.
For every language and source a minimum-covariance-determinant estimate is made: of the
texts, the three quarters that lie closest together decide mean and covariance, found by
concentration steps from two starts, of which the smaller determinant wins. Texts whose
Mahalanobis distance from their group's estimate is beyond a chi-square quantile are
rejected.

DataFrame functions only. A concentration step is two aggregations over the vectors:
histograms of the distances per group, which give the radius that holds three quarters,
and the moments of the rows within. Groups of a hot source are only partial sums.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.llm.common import SPACES, packed, stored, table

SYMBOLS = "#*$%&|<>"
VECTOR = ("v0", "v1", "v2", "v3")
#: Least standard deviation of each vector entry: what is below is no spread but rounding.
FLOOR = (0.12, 0.12, 0.25, 0.12)
#: Share of a group that decides its estimate; steps; least rows of a group of its own.
CORE, STEPS, LEAST_ROWS = 0.75, 5, 50
#: Share of clean texts that the chi-square radius would keep.
KEEP = 0.99999
#: Fixed limits of the contract's base rules.
LEAST_WORDS, MOST_REPEATED = 50, 50


def statistics(text: str) -> dict[str, Column]:
    """The base statistics of a text column. ``transform(array(x), ...)[0]`` binds x to a
    name, so that it is computed once and not once per element."""
    t = f"coalesce({text}, '')"
    words = f"filter(split({t}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')"
    repeated = f"""
      transform(array(transform({words}, w -> xxhash64(w))), h ->
        if(size(h) < 4, 0L,
          transform(array(array_sort(transform(sequence(1, size(h) - 2), i ->
              named_struct('k', xxhash64(get(h, i - 1), get(h, i), get(h, i + 1)), 'i', i)))), s ->
            transform(array(array_sort(transform(filter(sequence(0, size(s) - 1), j ->
                get(s, j).k <=> get(s, j - 1).k or get(s, j).k <=> get(s, j + 1).k), j -> get(s, j).i))), p ->
              aggregate(sequence(0, size(p)), 0L, (n, j) ->
                if(j >= size(p), n, n + coalesce(least(3, get(p, j + 1) - get(p, j)), 3))))[0])[0]))[0]"""
    lines = f"filter(split({t}, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    dup = f"transform(array({lines}), ls -> size(ls) - size(array_distinct(ls)))[0]"
    col = F.coalesce(F.col(text), F.lit(""))
    return {
        "n_words": F.expr(f"size({words})").cast("long"),
        "word_chars": F.char_length(F.translate(col, SPACES, "")).cast("long"),
        "n_symbols": (F.char_length(col) - F.char_length(F.translate(col, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": F.expr(dup).cast("long"),
        "n_repeat_words": F.expr(repeated).cast("long"),
    }


def vector() -> dict[str, Column]:
    """The statistics on scales where clean texts are about normal: log of the mean word
    length, root of the symbols a word, log of the repeated lines, root of the share of
    repeated words. All 0 for a text without words."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {"v0": F.log1p(F.col("word_chars") / n), "v1": F.sqrt(F.col("n_symbols") / n),
            "v2": F.log1p(F.col("n_dup_lines").cast("double")), "v3": F.sqrt(F.col("n_repeat_words") / n)}


def chi2_quantile(p: float, k: int) -> float:
    """Wilson-Hilferty approximation."""
    z = NormalDist().inv_cdf(p)
    return k * (1 - 2 / (9 * k) + z * math.sqrt(2 / (9 * k))) ** 3


def _even_chi2_cdf(x: float, k: int) -> float:
    term, total = 1.0, 1.0
    for i in range(1, k // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def consistency(core: float, k: int) -> float:
    """Factor that makes the core's covariance that of all rows, were they normal; k even."""
    lo, hi = 0.0, 100.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _even_chi2_cdf(mid, k) < core else (lo, mid)
    return core / _even_chi2_cdf(lo, k + 2)


def _estimate(rows: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Mean m*, inverse Cholesky factor w*_* of the covariance, and its log determinant, for
    every group of ``rows``; the floors are added to the variances."""
    sums = [F.count(F.lit(1)).alias("n")] + [F.avg(v).alias(f"m{i}") for i, v in enumerate(VECTOR)]
    sums += [F.covar_pop(VECTOR[i], VECTOR[j]).alias(f"c{i}_{j}") for i in range(len(VECTOR)) for j in range(i + 1)]
    est = rows.groupBy(*keys).agg(*sums)
    return _invert(est, keys, factor)


def _invert(est: DataFrame, keys: list[str], factor: float) -> DataFrame:
    d = len(VECTOR)
    for i in range(d):
        for j in range(i + 1):
            c = F.col(f"c{i}_{j}") * factor + (FLOOR[i] ** 2 if i == j else 0.0)
            for k in range(j):
                c = c - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            value = F.sqrt(F.greatest(c, F.lit(FLOOR[i] ** 2 / 100))) if i == j else c / F.col(f"l{j}_{j}")
            est = est.withColumn(f"l{i}_{j}", value)
    for i in range(d):
        est = est.withColumn(f"w{i}_{i}", 1 / F.col(f"l{i}_{i}"))
        for j in range(i):
            s = sum((F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)), F.lit(0.0))
            est = est.withColumn(f"w{i}_{j}", -s / F.col(f"l{i}_{i}"))
    logdet = sum((F.log(F.col(f"l{i}_{i}")) for i in range(d)), F.lit(0.0))
    return est.select(*keys, "n", *[f"m{i}" for i in range(d)],
                      *[f"w{i}_{j}" for i in range(d) for j in range(i + 1)], logdet.alias("logdet"))


def distance() -> Column:
    """Squared Mahalanobis distance of a row joined to its group's estimate."""
    total = F.lit(0.0)
    for i in range(len(VECTOR)):
        part = sum((F.col(f"w{i}_{j}") * (F.col(VECTOR[j]) - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0))
        total = total + part * part
    return total


def _core(rows: DataFrame, est: DataFrame, keys: list[str]) -> DataFrame:
    """The rows within the least radius (to a sixteenth of a power of two) that holds the
    core's share of their group."""
    near = rows.join(est, keys).withColumn("d2", distance()).withColumn(
        "ring", F.floor(F.log2(F.greatest("d2", F.lit(2.0 ** -20))) * 16).cast("int"))
    rings = near.groupBy(*keys, "ring").agg(F.count(F.lit(1)).alias("c"))
    own = Window.partitionBy(*keys)
    upto = own.orderBy("ring").rowsBetween(Window.unboundedPreceding, 0)
    limits = (rings.withColumn("below", F.sum("c").over(upto)).withColumn("all", F.sum("c").over(own))
              .where(F.col("below") >= CORE * F.col("all")).groupBy(*keys).agg(F.min("ring").alias("last")))
    return near.join(stored(limits, "mcd_rings"), keys).where("ring <= last").select(*keys, *VECTOR)


def robust_estimates(rows: DataFrame, key: str) -> DataFrame:
    """For every group its minimum-covariance-determinant estimate."""
    keys = [key, "start"]
    pooled = _estimate(rows, [key], 1.0).withColumn("start", F.lit(0))
    middle = [F.percentile_approx(v, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, v in enumerate(VECTOR)]
    spread = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *middle)
    spread = spread.select(key, "n", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(len(VECTOR))], *[
        (F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) if i == j else F.lit(0.0)).alias(f"c{i}_{j}")
        for i in range(len(VECTOR)) for j in range(i + 1)])
    robust = _invert(spread, [key], 1.0).withColumn("start", F.lit(1))
    est = stored(pooled.unionByName(robust), "mcd_start")
    twice = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1)))).select(*keys, *VECTOR)
    factor = consistency(CORE, len(VECTOR))
    for _ in range(STEPS):
        est = stored(_estimate(_core(twice, est, keys), keys, factor), "mcd_step")
    best = Window.partitionBy(key).orderBy("logdet", "start")
    return est.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank", "start", "n", "logdet")


def _tag(name: str) -> Column:
    c = F.col(f"`{name}`").cast("string")
    return F.coalesce(F.concat(F.lit("="), c), F.lit("-"))


def quality_outliers(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source") -> DataFrame:
    """One row per input row: ``_row`` (the input row without the text), the base statistics,
    base_failed, distance2 (squared Mahalanobis distance) and kept.

    Estimates come from the rows that pass the base rules. A language and source of
    fewer than LEAST_ROWS such rows is judged with its language, a language of fewer
    with all. NULL language or source is a value of its own; NULL text has no words and
    fails the base rules; repeated rows count each and are judged alike; without any row
    that passes there are no estimates and nothing is kept. An empty table gives no rows.
    """
    named = statistics("text")
    rows = packed(docs, lang=_tag(lang_col), source=_tag(source_col), text=F.col(f"`{text_col}`").cast("string"))
    slim = [c for c in docs.columns if c != text_col]
    rows = rows.select(F.struct(*[F.col("_row")[c].alias(c) for c in slim]).alias("_row"), "lang", "source",
                       *[c.alias(k) for k, c in named.items()])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = stored(rows.withColumns(vector()).withColumn("base_failed", failed), "mcd_rows")
    counts = rows.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    counts = rows.select("lang", "source").distinct().join(counts, ["lang", "source"], "left").fillna(0, ["n"])
    of_lang = F.sum("n").over(Window.partitionBy("lang"))
    groups = stored(counts.select(
        "lang", "source", F.when(F.col("n") >= LEAST_ROWS, F.concat_ws("\u0001", "lang", "source"))
        .when(of_lang >= LEAST_ROWS, F.col("lang")).otherwise(F.lit("")).alias("grp"), "n"), "mcd_groups")
    # a pooled group is estimated from all rows of its language, or from all rows
    good = rows.where("not base_failed").join(groups, ["lang", "source"])
    pools = groups.where("not contains(grp, '\u0001')").select(F.col("grp").alias("pool")).distinct()
    everything = not pools.where("pool = ''").isEmpty()
    good = good.join(pools.where("pool != ''"), F.col("lang") == F.col("pool"), "left")
    wanted = F.array(F.when(F.contains("grp", F.lit("\u0001")), F.col("grp")), F.col("pool"),
                     F.when(F.lit(everything), F.lit("")))
    cases = good.select(F.explode(F.array_compact(wanted)).alias("grp"), *VECTOR)
    est = stored(robust_estimates(stored(cases, "mcd_cases"), "grp"), "mcd_estimates")
    judged = rows.join(groups.drop("n"), ["lang", "source"]).join(est, "grp", "left").withColumn("distance2", distance())
    inside = F.coalesce(F.col("distance2") <= chi2_quantile(KEEP, len(VECTOR)), F.lit(False))
    return judged.select("_row", *named, "base_failed", "distance2", (~F.col("base_failed") & inside).alias("kept"))


def op4_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (quality_outliers(table(spark, sf_dir, "documents"))
            .select("_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", F.round("distance2", 6).alias("distance2")))
