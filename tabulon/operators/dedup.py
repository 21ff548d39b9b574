"""Distinct rows and deterministic deduplication by a key subset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order_by`` order (remaining columns break ties).

    ``dropDuplicates(keys)`` keeps an arbitrary row; a ``row_number`` window keeps a
    defined one but sends every row of a key to one task — a hot key holding a third
    of the table would make one task read a third of it. Here the choice is
    ``min(struct(order..., rest...))`` per key: an aggregate with map-side partial
    results, so each task forwards at most one row per key it has seen. Maps, which have no
    order, take part in ties by their sorted entries.
    """
    keys = list(keys)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    order_names = [f"__o{i}" for i in range(len(order_cols))]
    rest = [c for c in df.columns if c not in keys]
    maps = {c for c in rest if isinstance(df.schema[c].dataType, MapType)}
    packed = F.struct(*[c.alias(n) for c, n in zip(order_cols, order_names)],
                      *[(F.array_sort(F.map_entries(f"`{c}`")) if c in maps else F.col(f"`{c}`")).alias(c) for c in rest])
    best = df.groupBy(*keys).agg(F.min(packed).alias("__best"))
    back = [F.map_from_entries(F.col(f"__best.`{c}`")) if c in maps else F.col(f"__best.`{c}`") for c in rest]
    return best.select(*keys, *[x.alias(c) for x, c in zip(back, rest)]).select(*df.columns)
