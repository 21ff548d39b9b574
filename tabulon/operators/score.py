"""Batch scoring with a fitted (or loaded) pipeline: whole DataFrames, not one typed-in row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.fixed import (
    ACTUAL_COL, EXPECTED_COL, POLICY_LABELS, PREDICTION_TEXT_COL, STATUS_COL,
)
from tabulon.functions.scalar import decode_labels, threshold_flag


def score_claims(model: PipelineModel, claims: DataFrame, actual: str,
                 id_cols: Sequence[str] = ()) -> DataFrame:
    """Expected (model) vs actual amount, both rounded to cents, and the claim flag.

    A claim is 'Abnormal Claim' when the expected amount is below the actual one;
    rounding happens before the comparison, as in the reference.
    """
    scored = model.transform(claims)
    out = scored.select(*id_cols,
                        F.round("prediction", 2).alias(EXPECTED_COL),
                        F.round(actual, 2).alias(ACTUAL_COL))
    return out.withColumn(STATUS_COL, threshold_flag(EXPECTED_COL, ACTUAL_COL))


def score_fraud(model: PipelineModel, records: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """Class prediction as text; the ids the reference dropped are kept."""
    scored = model.transform(records)
    label = decode_labels("prediction", POLICY_LABELS)
    return scored.select(*id_cols, label.alias(PREDICTION_TEXT_COL))
