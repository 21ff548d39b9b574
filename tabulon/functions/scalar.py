"""Scalar expressions: CASE encoders/decoders, flags, rounding, hash buckets.

All are plain Catalyst expressions, so they stay inside whole-stage codegen.
Under ANSI mode (Spark 4 default) a CASE whose branches mix text and numbers
casts the text branch and fails on the first non-numeric value; the encoders here
cast explicitly (``try_cast`` / ``cast('string')``) so they never do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tabulon.functions.fixed import ABNORMAL_CLAIM, NORMAL_CLAIM


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def null_when(cond: Column, col: str | Column) -> Column:
    """``CASE WHEN cond THEN NULL ELSE col END``."""
    return F.when(cond, F.lit(None)).otherwise(_c(col))


def binary_label(col: str | Column, mapping: Mapping[str, int]) -> Column:
    """Chained CASE to int; any other text goes through ``try_cast`` (NULL if not a number)."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    return expr.otherwise(c.try_cast("int")).cast("int")


def map_labels(col: str | Column, mapping: Mapping, dtype: str = "int") -> Column:
    """Dictionary lookup; unmapped values (and NULL) give NULL."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    return expr.cast(dtype)


def decode_labels(col: str | Column, mapping: Mapping) -> Column:
    """Numeric code -> text; codes not in ``mapping`` keep their own text form."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    return expr.otherwise(c.cast("string"))


def threshold_flag(expected: str | Column, actual: str | Column,
                   above: str = ABNORMAL_CLAIM, otherwise: str = NORMAL_CLAIM) -> Column:
    """``above`` when expected < actual; NULL on either side gives ``otherwise``."""
    return F.when(_c(expected) < _c(actual), F.lit(above)).otherwise(F.lit(otherwise))


def round_half_up(col: str | Column, scale: int) -> Column:
    """Spark's ``round`` rounds HALF_UP on the decimal form of the double."""
    return F.round(_c(col), scale)


def is_missing(col: str, dtype) -> Column:
    """NULL, or NaN for floating columns (pandas ``isnull`` sees both)."""
    c = F.col(col)
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def net_amount(price: str = "l_extendedprice", discount: str = "l_discount",
               tax: str = "l_tax") -> Column:
    """Charged amount of an invoice line: price after discount, plus tax."""
    return F.col(price) * (1 - F.col(discount)) * (1 + F.col(tax))


def hash_bucket(keys: Sequence[str | Column], seed: int, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets) from an md5 of the key text and a seed.

    Unlike ``randomSplit`` it does not depend on partitioning or file order, so a
    split (or fold) repeats exactly on any cluster and in DuckDB.
    """
    parts = [_c(k).cast("string") for k in keys] + [F.lit(str(seed))]
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")
