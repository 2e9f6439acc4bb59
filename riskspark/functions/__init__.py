"""Column expressions shared by the operators."""

from riskspark.functions.columns import (
    as_number, at_or_above, count_where, hash_key, invalid_score, is_missing, is_numeric, is_string, non_finite, ratio,
)
from riskspark.functions.tables import free_name, small_table

__all__ = [
    "as_number", "at_or_above", "count_where", "free_name", "hash_key", "invalid_score", "is_missing", "is_numeric", "is_string",
    "non_finite", "ratio", "small_table",
]
