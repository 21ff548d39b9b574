"""Column expressions built only from ``pyspark.sql.functions`` (JVM side, codegen)."""

from tabulon.functions.scalar import (
    binary_label, decode_labels, hash_bucket, map_labels, net_amount, null_when,
    round_half_up, threshold_flag, is_missing,
)

__all__ = [
    "binary_label", "decode_labels", "hash_bucket", "map_labels", "net_amount", "null_when",
    "round_half_up", "threshold_flag", "is_missing",
]
