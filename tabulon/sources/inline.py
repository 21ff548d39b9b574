"""Inline rows -> DataFrame with an explicit schema (no inference)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def inline_table(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """For lookup data typed in by hand; what grows belongs in a file source."""
    return spark.createDataFrame(list(rows), schema=schema)
