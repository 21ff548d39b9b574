"""Sampled Shapley attributions as one Spark job (Štrumbelj & Kononenko, 2014).

For every explained row x, permutation j = 0..P-1 and background row b of B:

* the feature order is a permutation drawn from hashes of (row, j, feature), so a
  retried task rebuilds the same rows;
* F+1 hybrid rows are generated in the task (``explode``): step k takes the first
  k features of the permutation from x and the rest from b;
* one ``model.transform`` scores every hybrid row;
* the contribution of the feature switched at step k is f(step k) - f(step k-1),
  summed as +f / -f terms per record, so no window or per-permutation regrouping.

Every record meets the whole background (a broadcast table of checked size), so all
records have the same base value, the mean of f over the background, and
``sum(phi) = f(x) - base`` up to float rounding. For a model that is linear in its
features phi is exactly weight * (x - background mean).

Features are the raw input columns (before encoding), so one-hot slots of a
category move together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.operators.models import positive_probability
from tabulon.session import cut_lineage

def background_sample(df: DataFrame, features: Sequence[str], size: int, keys: Sequence[str] = (),
                      seed: int = 17) -> DataFrame:
    """``size`` rows picked by smallest hash (a bounded top-k), numbered 0..size-1. The hash
    is of the record's ``keys`` (the features if none are given: equal rows then come
    together)."""
    by = list(keys) or list(features)
    h = F.xxhash64(*[F.col(f"`{c}`") for c in by], F.lit(seed))
    cols = [c for c in dict.fromkeys([*features, *by])]
    picked = df.select(*cols).withColumn("__h", h).orderBy("__h", *cols).limit(size)
    w = Window.orderBy("__h", *cols)  # <= size rows: bounded single-task window
    return (picked.withColumn("bg_idx", (F.row_number().over(w) - 1).cast("int")).select(*features, "bg_idx"))


def _output(scored: DataFrame, output: str) -> Column:
    if output == "probability":
        return positive_probability("probability")
    return F.col(output).cast("double")


def shapley_wide(model: PipelineModel, rows: DataFrame, id_col: str, features: Sequence[str],
                 background: DataFrame, permutations: int = 4, seed: int = 17,
                 output: str = "prediction", max_background: int = 10_000) -> DataFrame:
    """One row per explained record: id, ``value__<f>`` (text), ``phi__<f>``, base, fx.

    ``background`` (see ``background_sample``) is broadcast; at most ``max_background``
    rows. Records are told apart by a row number written to the shared folder, so equal
    ids do not mix.

    No window is needed: the scored hybrid row at step k is the "after" value of the
    feature switched at step k and the "before" value of the one switched at step
    k+1, so phi(feature) is a sum of +f and -f terms over the record's hybrid rows.
    All hybrid rows of a record are generated in one task, so the aggregation by
    record (fixed-width double buffers, HashAggregate) completes map-side; the shuffle
    carries one row of numbers per record, and ids and values join it at the end.
    """
    features = list(features)
    nf = len(features)
    picked = background.select(*[F.col(f"`{c}`").alias(f"bg__{c}") for c in features])
    bg_rows = picked.limit(max_background + 1).collect()
    n_bg = len(bg_rows)
    if n_bg == 0:
        raise ValueError("empty background sample")
    if n_bg > max_background:
        raise ValueError(f"background sample larger than {max_background} rows")
    bg = F.array(*[F.struct(*[F.lit(r[i]).cast(picked.schema[i].dataType).alias(f"b{i}") for i in range(nf)])
                   for r in bg_rows])
    base = cut_lineage(rows.select(F.col(id_col).alias("__id"), *features)
                       .withColumn("__row", F.monotonically_increasing_id()))
    drawn = base.select("__row", *features, F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))).alias("__j"))
    # permutation of feature indices: sort (hash, index) pairs, keep the indices
    perm = F.transform(
        F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(nf - 1)),
                                 lambda i: F.struct(F.xxhash64(F.col("__row"), F.col("__j"), i, F.lit(seed)).alias("h"),
                                                    i.alias("i")))),
        lambda s: s["i"])
    paired = drawn.withColumn("__perm", perm).withColumn("__b", F.explode(bg))
    steps = paired.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(nf))))
    k = F.col("__k")
    # feature i comes from x once the step has passed its position in the permutation
    hybrid = steps.select(
        "__row", k,
        F.when(k > 0, F.col("__perm")[k - 1]).alias("__after"),      # switched at step k
        F.when(k < nf, F.col("__perm")[k]).alias("__before"),        # switched at step k+1
        *[F.when(F.array_position("__perm", F.lit(i)) - 1 < k, F.col(f"`{c}`"))
           .otherwise(F.col(f"__b.b{i}")).alias(c) for i, c in enumerate(features)])
    scored = model.transform(hybrid)
    f = scored.select("__row", "__k", "__after", "__before", _output(scored, output).alias("__f"))

    zero = F.lit(0.0)
    phis = [(F.sum(F.when(F.col("__after") == i, F.col("__f")).otherwise(zero)
                   - F.when(F.col("__before") == i, F.col("__f")).otherwise(zero)) / (permutations * n_bg))
            .alias(f"phi__{c}") for i, c in enumerate(features)]
    wide = f.groupBy("__row").agg(
        *phis,
        F.avg(F.when(F.col("__k") == 0, F.col("__f"))).alias("base"),
        F.max(F.when(F.col("__k") == nf, F.col("__f"))).alias("fx"))
    named = base.select("__row", F.col("__id").alias(id_col),
                        *[F.col(f"`{c}`").cast("string").alias(f"value__{c}") for c in features])
    return named.join(wide, "__row").select(id_col, *[f"value__{c}" for c in features],
                                            *[f"phi__{c}" for c in features], "base", "fx")


def contributions_from_wide(wide: DataFrame, id_col: str, features: Sequence[str]) -> DataFrame:
    """(id, feature, value, phi, base, fx): one row per record and feature (in-row unpivot)."""
    items = [F.struct(F.lit(c).alias("feature"), F.col(f"value__{c}").alias("value"),
                      F.col(f"phi__{c}").alias("phi")) for c in features]
    return wide.select(id_col, "base", "fx", F.inline(F.array(*items))).select(
        id_col, "feature", "value", "phi", "base", "fx")


def shapley_contributions(model: PipelineModel, rows: DataFrame, id_col: str, features: Sequence[str],
                          background: DataFrame, permutations: int = 4, seed: int = 17,
                          output: str = "prediction") -> DataFrame:
    """Per (id, feature): value, phi, base, fx."""
    wide = shapley_wide(model, rows, id_col, features, background, permutations, seed, output)
    return contributions_from_wide(wide, id_col, features)


def shapley_summary(contrib: DataFrame, top: int = 10) -> DataFrame:
    """Global importance: (feature, mean_abs_phi), top ``top`` features."""
    imp = contrib.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    return imp.orderBy(F.desc("mean_abs_phi"), "feature").limit(top)


def shapley_summary_wide(wide: DataFrame, features: Sequence[str], top: int = 10) -> DataFrame:
    """Same ranking from the wide table: one aggregate, no regrouping by feature."""
    agg = wide.agg(*[F.avg(F.abs(f"phi__{c}")).alias(f"m{i}") for i, c in enumerate(features)])
    ranked = agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean_abs_phi"))
        for i, c in enumerate(features)])))
    return ranked.orderBy(F.desc("mean_abs_phi"), "feature").limit(top)


def additivity_wide(wide: DataFrame, id_col: str, features: Sequence[str], tol: float = 1e-6) -> DataFrame:
    """Per record: sum of phi vs f(x) - base, computed in the record's own row."""
    total = sum((F.col(f"phi__{c}") for c in features), F.lit(0.0))
    gap = F.abs(total - (F.col("fx") - F.col("base")))
    return wide.select(id_col, total.alias("sum_phi"), "base", "fx",
                       (gap <= F.lit(tol) * F.greatest(F.lit(1.0), F.abs("fx"))).alias("additive"))


def additivity(contrib: DataFrame, id_col: str, tol: float = 1e-6) -> DataFrame:
    """Per row: sum(phi) vs f(x) - base, and whether they agree within ``tol`` (relative)."""
    per = contrib.groupBy(id_col).agg(F.sum("phi").alias("sum_phi"), F.first("base").alias("base"),
                                      F.first("fx").alias("fx"))
    gap = F.abs(F.col("sum_phi") - (F.col("fx") - F.col("base")))
    return per.withColumn("additive", gap <= F.lit(tol) * F.greatest(F.lit(1.0), F.abs("fx")))
