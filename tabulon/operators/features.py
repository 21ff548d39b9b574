"""Feature recipes on MLlib stages, dummy columns, feature names.

The reference builds 73 single-column stages (18 indexers, 18 encoders, 18
one-column assemblers, 18 scalers, 1 assembler); each scaler fit is its own job.
``feature_recipe`` builds the same ``features`` vector from 5 multi-column stages:
one StringIndexer and one OneHotEncoder over all categorical columns, one
assembler + one MinMaxScaler over all numeric columns (one Summarizer pass for
every min/max), one final assembler.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.operators.columns import split_by_type
from tabulon.operators.joins import skew_join
from tabulon.session import cut_lineage

# Dummy columns are one projection per distinct value; above this many levels in a
# column the encoding is refused (use the indexer + one-hot vector instead).
MAX_DUMMY_LEVELS = 1_000


def category_levels(df: DataFrame, col: str, max_levels: int = MAX_DUMMY_LEVELS) -> list:
    """Sorted distinct non-NULL values of ``col``; fails above ``max_levels``.

    The distinct is an aggregate (map-side partial); at most max_levels + 1 values
    ever reach the driver.
    """
    vals = (df.select(col).where(F.col(col).isNotNull()).distinct()
            .limit(max_levels + 1).collect())
    if len(vals) > max_levels:
        raise ValueError(f"{col!r} has more than {max_levels} levels; use one-hot vectors")
    return sorted(r[0] for r in vals)


def dummies(df: DataFrame, cols: Sequence[str], drop_first: bool = False,
            max_levels: int = MAX_DUMMY_LEVELS, keep_source: bool = False) -> DataFrame:
    """Indicator columns ``{col}_{value}`` (int 0/1) for every level, levels sorted.

    ``drop_first`` drops the alphabetically first level (pandas ``get_dummies``
    semantics — unlike OneHotEncoder, which drops the *least frequent* index).
    NULL gives 0 in every indicator of its column.
    """
    out = {}
    for c in cols:
        levels = category_levels(df, c, max_levels)
        if drop_first:
            levels = levels[1:]
        for v in levels:
            out[f"{c}_{v}"] = F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
    res = df.withColumns(out)
    return res if keep_source else res.drop(*cols)


# StringIndexer brings every label of a column to the driver and broadcasts the
# mapping; above this many levels the fit is refused (near-unique columns such as
# ids or free text should be dropped first, see profile.drop_uninformative).
MAX_INDEX_LEVELS = 1_000_000

# Most rows (so, values) of the range of a label table that one task sorts, about.
LABELS_A_RANGE = 500_000


def check_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_INDEX_LEVELS) -> dict[str, int]:
    """Approximate distinct count of each column (HyperLogLog++, one pass); raises if
    any column exceeds ``max_levels``."""
    if not cols:
        return {}
    row = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`"), 0.05).alias(c) for c in cols]).first()
    counts = {c: int(row[c]) for c in cols}
    over = {c: n for c, n in counts.items() if n > max_levels}
    if over:
        raise ValueError(f"too many levels to index (limit {max_levels}): {over}")
    return counts


def index_stage(cols: Sequence[str], handle_invalid: str = "error", suffix: str = "_index") -> StringIndexer:
    """Labels by descending frequency (ties alphabetical); ``keep`` maps unseen/NULL to numLabels."""
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols],
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def label_table(df: DataFrame, col: str) -> DataFrame:
    """(value, n, label) of a column's values as text: labels 0, 1, 2 ... (double) by descending
    frequency, ties by value, as ``StringIndexer`` numbers them, for any number of values.

    The counts are range-partitioned and sorted in that order, a range for so many rows, and
    written; a label is the place within its range plus the size of the ranges before it. No
    list of labels reaches the driver. NULL has no label.
    """
    values = df.select(F.col(f"`{col}`").cast("string").alias("value")).where("value is not null")
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")]
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-values.count() // LABELS_A_RANGE))
    # the id has the partition above its 33 low bits and the place in the partition in them
    ranges = cut_lineage(counts.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("at", F.monotonically_increasing_id())
                         .select("value", "n", F.shiftright("at", 33).alias("range"),
                                 F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("place")))
    sizes = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("size"))  # a row for each partition
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return (ranges.join(F.broadcast(starts), "range")
            .select("value", "n", (F.col("start") + F.col("place")).cast("double").alias("label")))


def index_by_table(df: DataFrame, col: str, labels: DataFrame, into: str | None = None,
                   handle_invalid: str = "error", rows_per_task: int = 1_000_000) -> DataFrame:
    """``df`` with the label of ``col`` from a ``label_table``, joined with hot values split.

    A value that the table lacks, or NULL: ``keep`` numbers it as the first label after the
    table's, ``skip`` drops the row, ``error`` fails the call where there is such a row.
    """
    if handle_invalid not in ("error", "keep", "skip"):
        raise ValueError(f"handle_invalid {handle_invalid!r}")
    into = into or f"{col}_index"
    keyed = df.withColumn("__value", F.col(f"`{col}`").cast("string"))
    table = cut_lineage(labels.select(F.col("value").alias("__value"), F.col("label").alias("__label")))
    out = skew_join(keyed, table, "__value", "inner" if handle_invalid == "skip" else "left", rows_per_task)
    if handle_invalid == "error" and not out.where("__label is null").isEmpty():
        raise ValueError(f"{col!r} has values without a label")
    label = F.col("__label")
    if handle_invalid == "keep":
        label = F.coalesce(label, F.lit(float(table.count())))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != into], label.alias(into))


def one_hot_stage(cols: Sequence[str], in_suffix: str = "_index", suffix: str = "_encoded") -> OneHotEncoder:
    """n-1 slots per column (last index dropped). After a ``keep`` indexer the dropped
    slot is the unseen bucket, so every known label keeps a slot."""
    return OneHotEncoder(inputCols=[f"{c}{in_suffix}" for c in cols],
                         outputCols=[f"{c}{suffix}" for c in cols], dropLast=True)


def scale_stages(cols: Sequence[str], out: str = "numeric_scaled", handle_invalid: str = "error") -> list:
    """One assembler + one MinMaxScaler for all numeric columns (constant column -> 0.5).

    NULL numbers fail by default (impute first); ``keep`` passes them on as NaN.
    """
    return [VectorAssembler(inputCols=list(cols), outputCol=f"{out}__raw", handleInvalid=handle_invalid),
            MinMaxScaler(inputCol=f"{out}__raw", outputCol=out)]


def feature_recipe(categorical: Sequence[str], numeric: Sequence[str], *,
                   handle_invalid: str = "keep", output: str = "features",
                   assemble_invalid: str = "error") -> Pipeline:
    """Categorical: index (unseen kept) + one-hot; numeric: min-max scaled; one vector."""
    stages = []
    inputs = []
    if categorical:
        stages += [index_stage(categorical, handle_invalid), one_hot_stage(categorical)]
        inputs += [f"{c}_encoded" for c in categorical]
    if numeric:
        stages += scale_stages(numeric, handle_invalid=assemble_invalid)
        inputs.append("numeric_scaled")
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid=assemble_invalid))
    return Pipeline(stages=stages)


def recipe_from_schema(df: DataFrame, label: str, exclude: Sequence[str] = (), **kw) -> Pipeline:
    """Recipe with column roles read from the schema (label and ``exclude`` left out)."""
    numeric, categorical = split_by_type(df.schema, exclude=[label, *exclude])
    return feature_recipe(categorical, numeric, **kw)


def regression_recipe(index_cols: Sequence[str], onehot_cols: Sequence[str], scaled_cols: Sequence[str],
                      raw_cols: Sequence[str] = (), output: str = "features") -> Pipeline:
    """The regression notebook's layout: index some columns, one-hot some of those,
    min-max scale some numerics, pass others through; assembled in that order."""
    stages = [index_stage(index_cols)]
    if onehot_cols:
        stages.append(one_hot_stage(onehot_cols))
    stages += scale_stages(scaled_cols)
    inputs = ([f"{c}_index" for c in index_cols if c not in onehot_cols]
              + [f"{c}_encoded" for c in onehot_cols] + ["numeric_scaled"] + list(raw_cols))
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return Pipeline(stages=stages)


def vectorize_features(df: DataFrame, input_cols: Sequence[str], target: str,
                       keep: Sequence[str] = ()) -> DataFrame:
    """Assemble ``input_cols`` to ``features``, rename target to ``label``,
    keep ``(label, features)`` (plus any ``keep`` columns)."""
    asm = VectorAssembler(inputCols=list(input_cols), outputCol="features")
    return asm.transform(df.withColumnRenamed(target, "label")).select(*keep, "label", "features")


def feature_names(df: DataFrame, vector_col: str = "features", scaled: Sequence[str] = (),
                  scaled_as: str = "numeric_scaled") -> list[str]:
    """Slot names from the vector's ML attribute metadata, in slot order. The scaler drops
    its inputs' names; given the columns that were ``scaled``, in order, their slots are
    named ``{column}_normalized``."""
    own = {f"{scaled_as}_{i}": f"{c}_normalized" for i, c in enumerate(scaled)}
    meta = df.schema[vector_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = [(a["idx"], a["name"]) for group in attrs.values() for a in group]
    return [own.get(name, name) for _, name in sorted(slots)]


def block_sums(vector: Column, first: int) -> tuple[Column, Column]:
    """The sums of a vector's first ``first`` slots and of the rest, each in slot order. Only the
    slots that the vector stores are read: a one-hot block of many slots stores one a column."""
    stored = F.unwrap_udt(vector)  # a sparse vector (type 0) has the slots of its values in indices
    below = F.when(stored["type"] == 0, F.size(F.filter(stored["indices"], lambda i: i < first))).otherwise(first)

    def total(start, length):
        return F.aggregate(F.slice(stored["values"], start, length), F.lit(0.0), lambda x, y: x + y)

    return total(F.lit(1), below), total(below + 1, F.size(stored["values"]))
