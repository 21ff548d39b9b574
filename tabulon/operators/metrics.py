"""Exact evaluation metrics as Spark aggregates over a scored table.

None brings scored rows to the driver. ROC AUC is exact (ties get half credit): rows
are grouped by score, so a hot score becomes one row, and the running count of negatives
is a window within each range of scores plus what lies in the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.session import cut_lineage


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def auc(df: DataFrame, label: str | Column = "label", score: str | Column = "score",
        by: Sequence[str] = ()) -> DataFrame:
    """One row (for each value of the columns ``by``): (auc, n_pos, n_neg). ``label`` is 1 for
    positives, 0 for negatives; rows with a NULL label or a NULL/NaN score are left out.

    AUC = sum over distinct scores p of pos(p) * (neg(< p) + neg(= p)/2) / (P * N),
    the Mann-Whitney statistic with average ranks for ties. The distinct scores are
    range-partitioned; what lies below a partition is the sum of the partitions before
    it, and the running count is a window within each.
    """
    by = list(by)
    y = _c(label).cast("int")
    g = (df.select(*by, y.alias("y"), _c(score).cast("double").alias("p"))
           .where(F.col("y").isNotNull() & F.col("p").isNotNull() & ~F.isnan("p"))
           .groupBy(*by, "p").agg(F.count_if(F.col("y") == 1).alias("np"),
                                  F.count_if(F.col("y") == 0).alias("nn")))
    # The range boundaries must be the same for the totals and the windows, so the
    # partitioned scores are written once, to the shared folder.
    g = cut_lineage(g.repartitionByRange(*by, "p").withColumn("b", F.spark_partition_id()))
    per_range = g.groupBy(*by, "b").agg(F.sum("nn").alias("bn"))  # a row per partition (and group)
    upto = (Window.partitionBy(*by) if by else Window).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(*by, "b", F.sum("bn").over(upto).alias("off"))
    within = Window.partitionBy(*by, "b").orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (g.withColumn("below_in", F.sum("nn").over(within) - F.col("nn"))
               .join(offsets if by else F.broadcast(offsets), [*by, "b"])
               .withColumn("below", F.coalesce(F.col("off"), F.lit(0)) + F.col("below_in")))
    return ranked.groupBy(*by).agg(
        F.round(F.try_divide(F.sum(F.col("np") * (F.col("below") + F.col("nn") / 2.0)),
                             F.sum("np").cast("double") * F.sum("nn").cast("double")), 6).alias("auc"),
        F.sum("np").cast("bigint").alias("n_pos"),
        F.sum("nn").cast("bigint").alias("n_neg"))


def regression_metrics(df: DataFrame, label: str | Column = "label",
                       prediction: str | Column = "prediction") -> DataFrame:
    """(n, mse, rmse, r2): MSE and RMSE to 2 places, R² to 4, as the reference prints,
    over the rows that have both a label and a prediction.

    RMSE is the root of the *rounded* MSE (reference order). R² = 1 - SSE/SST with
    SST = n * var_pop(label) — not ``regr_r2``, which is a squared correlation.
    """
    y, p = _c(label).cast("double"), _c(prediction).cast("double")
    a = (df.select(F.nanvl(y, F.lit(None)).alias("y"), F.nanvl(p, F.lit(None)).alias("p"))
         .where("y is not null and p is not null").agg(
             F.count(F.lit(1)).alias("n"),
             F.sum(F.pow(F.col("y") - F.col("p"), 2)).alias("sse"),
             F.var_pop("y").alias("vy")))
    mse = F.round(F.try_divide(F.col("sse"), F.col("n")), 2)
    return a.select(
        "n", mse.alias("mse"), F.round(F.sqrt(mse), 2).alias("rmse"),
        F.round(1 - F.try_divide(F.col("sse"), F.col("vy") * F.col("n")), 4).alias("r2"))


def confusion_metrics(df: DataFrame, label: str | Column = "label",
                      prediction: str | Column = "prediction", positive: int = 1) -> DataFrame:
    """Confusion counts and accuracy, precision, recall, F1, Cohen's kappa, MCC (6 places).

    ``positive`` is the stated class; all others are negative, so tp, fp, tn and fn are
    one against the rest. Accuracy and kappa compare the classes themselves: taking
    class 2 for class 3 is an error. Rows without a label or a prediction are left out.
    """
    y, p = _c(label).cast("int"), _c(prediction).cast("int")
    cells = (df.select(y.alias("y"), p.alias("p")).where("y is not null and p is not null")
             .groupBy("y", "p").agg(F.count(F.lit(1)).alias("n")))  # classes x classes
    # chance agreement: sum over classes of (labels of it) * (predictions of it)
    margins = (cells.select(F.inline(F.array(F.struct(F.col("y").alias("k"), F.col("n").alias("a"), F.lit(0).cast("long").alias("b")),
                                             F.struct(F.col("p").alias("k"), F.lit(0).cast("long").alias("a"), F.col("n").alias("b")))))
               .groupBy("k").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
               .agg(F.sum(F.col("a").cast("double") * F.col("b")).alias("chance")))
    yes, said = F.col("y") == positive, F.col("p") == positive
    counts = cells.agg(
        *[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long").alias(k)
          for k, c in (("tp", yes & said), ("fp", ~yes & said), ("tn", ~yes & ~said), ("fn", yes & ~said),
                       ("same", F.col("y") == F.col("p")))])
    a = counts.select("*", margins.scalar().alias("chance"))
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    div = F.try_divide  # undefined ratios (no positives, no predictions) are NULL, not errors
    precision = div(tp, tp + fp)
    recall = div(tp, tp + fn)
    po = div(F.col("same").cast("double"), n)
    pe = div(F.col("chance"), n * n)
    return a.select(
        "tp", "fp", "tn", "fn",
        F.round(po, 6).alias("accuracy"),
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(div(2 * precision * recall, precision + recall), 6).alias("f1"),
        F.round(div(po - pe, 1 - pe), 6).alias("kappa"),
        F.round(div(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))), 6).alias("mcc"))


class ConfusionEvaluator(Evaluator):
    """A column of ``confusion_metrics`` (accuracy, precision, recall, f1, kappa, mcc ...) as
    an evaluator, for cross-validation and the leaderboard; larger is better. A metric that
    is not defined (MCC of a constant answer) counts as 0."""

    def __init__(self, metric: str = "kappa", label: str = "label", prediction: str = "prediction"):
        super().__init__()
        self.metric, self.label, self.prediction = metric, label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        value = confusion_metrics(dataset, self.label, self.prediction).first()[self.metric]
        return float(value) if value is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True
