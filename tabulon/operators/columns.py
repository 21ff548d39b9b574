"""Projection and column edits (reference tour: select, selectExpr, withColumn,
drop, rename, conditional NULL, fill, label encode/decode, threshold flags).

These are one-line DataFrame calls; the helpers only fix the semantics the tour
relies on (ANSI-safe casts, NULL handling) and keep column roles typed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from tabulon.functions.fixed import POLICY_LABELS, PREDICTION_TEXT_COL
from tabulon.functions.scalar import binary_label, decode_labels, map_labels, null_when

#: Every number type: byte, short, int, long, float, double and decimal.
NUMERIC_TYPES = (NumericType,)


def copy_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Add copies ``new <- old`` in one projection (``withColumns`` avoids a plan per column)."""
    return df.withColumns({new: F.col(old) for new, old in mapping.items()})


def drop_columns(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Drop by name or by Column; unknown names are ignored, as in Spark."""
    for c in cols:
        df = df.drop(c)
    return df


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def set_null_where(df: DataFrame, col: str, cond: Column, into: str | None = None) -> DataFrame:
    """``col`` (or a new ``into``) becomes NULL where ``cond`` holds."""
    return df.withColumn(into or col, null_when(cond, col))


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``fillna`` per column; on float columns NaN is filled as well."""
    return df.fillna(dict(values))


def encode_binary(df: DataFrame, col: str, mapping: Mapping[str, int], into: str | None = None) -> DataFrame:
    return df.withColumn(into or col, binary_label(col, mapping))


def encode_map(df: DataFrame, col: str, mapping: Mapping, into: str | None = None,
               dtype: str = "int") -> DataFrame:
    return df.withColumn(into or col, map_labels(col, mapping, dtype))


def decode_prediction(df: DataFrame, col: str = "prediction",
                      mapping: Mapping | None = None, into: str = PREDICTION_TEXT_COL) -> DataFrame:
    mapping = mapping or POLICY_LABELS
    return df.withColumn(into, decode_labels(col, mapping))


def split_by_type(schema: StructType, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names in schema order.

    Numbers of every width, decimals too, are numeric; every other type (string, date,
    timestamp, boolean) counts as categorical.
    """
    numeric, categorical = [], []
    for f in schema.fields:
        if f.name in exclude:
            continue
        (numeric if isinstance(f.dataType, NUMERIC_TYPES) else categorical).append(f.name)
    return numeric, categorical


def columns_except(df: DataFrame, drop: Sequence[str]) -> list[str]:
    """Ordered column-set difference (the reference used an unordered set)."""
    gone = set(drop)
    return [c for c in df.columns if c not in gone]
