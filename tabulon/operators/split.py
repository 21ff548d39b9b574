"""Repeatable train/test splits and k-fold assignment from key hashes.

``randomSplit`` draws per partition, so the same seed gives different rows when
the input is partitioned differently; hashing a key does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabulon.functions.scalar import hash_bucket


SPLIT_BUCKETS = 1_000_000


def with_bucket(df: DataFrame, keys: Sequence[str], seed: int, buckets: int = 100,
                col: str = "bucket") -> DataFrame:
    return df.withColumn(col, hash_bucket(keys, seed, buckets))


def hash_split(df: DataFrame, keys: Sequence[str], seed: int = 123,
               train_fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(train, test): a row is in train when its key's bucket (of a million) lies below
    that share of a million."""
    cut = int(round(train_fraction * SPLIT_BUCKETS))
    b = hash_bucket(keys, seed, SPLIT_BUCKETS)
    return df.where(b < cut), df.where(b >= cut)


def with_folds(df: DataFrame, keys: Sequence[str], k: int, seed: int = 7, col: str = "fold") -> DataFrame:
    """Fold id in [0, k) for ``CrossValidator(foldCol=...)``."""
    return df.withColumn(col, hash_bucket(keys, seed, k))
