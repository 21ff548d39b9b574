"""Sort, limit, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def sort_desc(df: DataFrame, col: str, tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Global sort: range-partitioned exchange + per-partition sort (no single task)."""
    return df.orderBy(F.desc(col), *_cols(tiebreak))


def top_k(df: DataFrame, k: int, order: Sequence[str | Column]) -> DataFrame:
    """Sort + limit together plan as ``TakeOrderedAndProject``: each task keeps its
    own k best rows, so only tasks*k rows are merged — no full sort."""
    return df.orderBy(*_cols(order)).limit(k)


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    """``limit(n)``: any n rows (sort first for a defined choice)."""
    return df.limit(n)
