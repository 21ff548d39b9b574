"""Exports to the driver and to flat columns."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def preview_pandas(df: DataFrame, rows: int):
    """The first ``rows`` rows as pandas (Arrow transfer); the number is the caller's to
    state. Full results are written with ``sinks.write_table``.
    """
    return df.limit(rows).toPandas()


def vector_column_to_array(col: str | Column) -> Column:
    """ML vector -> array<double>, usable by SQL functions and Parquet."""
    return vector_to_array(F.col(col) if isinstance(col, str) else col, "float64")


def features_to_columns(df: DataFrame, vector_col: str, width: int, prefix: str = "f_",
                        keep: list[str] | None = None) -> DataFrame:
    """Spread a vector column into ``width`` double columns ``f_0 .. f_{width-1}``.

    Values are rounded to 6 places (and ``-0.0`` folded to ``0.0``) so that results
    compare across engines.
    """
    arr = vector_column_to_array(vector_col)
    tmp = "__arr"
    out = df.select(*(keep or []), arr.alias(tmp))
    return out.select(*(keep or []), *[
        (F.round(F.col(tmp)[i], 6) + F.lit(0.0)).alias(f"{prefix}{i}") for i in range(width)])
