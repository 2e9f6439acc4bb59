"""Null, NaN and ANSI rules in one place, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def is_string(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType)


def is_missing(name: str, dtype: T.DataType) -> Column:
    """Null, or NaN where the type has one."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def as_number(name: str) -> Column:
    """The column as a double, NaN as null."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def non_finite(name: str) -> Column:
    """Null, NaN or infinite; never null itself."""
    c = F.col(name).cast("double")
    return F.coalesce(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(True))


def invalid_score(name: str) -> Column:
    """No usable probability: null, NaN, infinite or outside [0, 1]; never null itself."""
    c = F.col(name).cast("double")
    return non_finite(name) | (c < 0) | (c > 1)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as a double, 0 where the denominator is 0."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )


def at_or_above(score: Column, threshold: float | Column) -> Column:
    """score >= threshold with NaN on the low side (Spark orders NaN above all numbers)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return ~F.isnan(score) & (score >= t)


def hash_key(key: str, seed: int) -> Column:
    """Hex digest giving every row a reproducible place in a random order."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
