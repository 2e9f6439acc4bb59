"""Row-level admission of scoring requests, and admission of whole tables.

A request row is checked field by field; each bad field is one violation with a
category, and a row with any violation goes to quarantine.  All of it is projections,
so the same code runs on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.config import BALANCES, FEATURES, NUMERIC_FEATURES, QUALITY_CATEGORIES, TRANSACTION_TYPES
from riskspark.errors import DriftDataError
from riskspark.functions import count_where, is_numeric, is_string, non_finite

VIOLATIONS = "violations"


def _number(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return c.try_cast("double") if is_string(df.schema[name].dataType) else c.cast("double")


def _violation(field: str, kind: str, category: str) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(kind).alias("kind"), F.lit(category).alias("category"))


def with_violations(df: DataFrame) -> DataFrame:
    """Add the list of violations of the six request fields; other columns are ignored.

    A column that is absent counts as missing in every row.
    """
    def numeric_rule(name: str, category: str) -> Column:
        if name not in df.columns:
            return _violation(name, "missing", "missing_field")
        value = _number(df, name)
        return (
            F.when(F.col(name).isNull(), _violation(name, "missing", "missing_field"))
            .when(value.isNull(), _violation(name, "not_a_number", category))
            .when(F.isnan(value) | (value < 0), _violation(name, "below_minimum", category))
        )

    if "type" in df.columns:
        kind = F.col("type")
        type_rule = (
            F.when(kind.isNull(), _violation("type", "missing", "missing_field"))
            .when(~kind.isin(*TRANSACTION_TYPES), _violation("type", "not_allowed", "invalid_type"))
        )
    else:
        type_rule = _violation("type", "missing", "missing_field")
    rules = [type_rule, numeric_rule("amount", "invalid_amount")]
    rules += [numeric_rule(b, "invalid_balance") for b in BALANCES]
    return df.withColumn(VIOLATIONS, F.filter(F.array(*rules), lambda v: v.isNotNull()))


def admissible(df: DataFrame) -> Column:
    """Whether a row has no violation: what ``with_violations`` says, as plain comparisons of each field, which Spark
    compiles, where filtering a list is interpreted with every expression below it written out many times."""
    fields = ("type", "amount", *BALANCES)
    if any(c not in df.columns for c in fields):
        return F.lit(False)

    def fits(name: str) -> Column:
        # the value once, as Spark writes out what it comes from wherever it stands
        return F.coalesce(F.nanvl(_number(df, name), F.lit(-1.0)) >= 0, F.lit(False))

    return reduce(and_, map(fits, fields[1:]), F.coalesce(F.col("type").isin(*TRANSACTION_TYPES), F.lit(False)))


def admit(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows with numeric fields, quarantined rows with their violations)."""
    numeric = [c for c in ("amount", *BALANCES) if c in df.columns]
    valid = df.where(admissible(df)).drop(VIOLATIONS).withColumns({c: _number(df, c) for c in numeric})
    return valid, with_violations(df.where(~admissible(df)))


def known_category(category: Column) -> Column:
    """Labels outside the known set count as invalid_type."""
    return F.when(category.isin(*QUALITY_CATEGORIES), category).otherwise("invalid_type")


def violations_long(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per violation."""
    checked = df if VIOLATIONS in df.columns else with_violations(df)
    return checked.select(*keep, F.inline(VIOLATIONS)).withColumn(
        "category", known_category(F.col("category"))
    )


def count_by_category(violations: DataFrame, category: str = "category") -> DataFrame:
    return violations.groupBy(known_category(F.col(category)).alias("category")).agg(
        F.count("*").alias("errors")
    )


# --- tables -----------------------------------------------------------------------

def _check_drift_schema(df: DataFrame, name: str, features: Sequence[str], numeric: Sequence[str]) -> None:
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise DriftDataError(f"{name} table lacks features: {', '.join(missing)}")
    for c in numeric:
        if not is_numeric(df.schema[c].dataType):
            raise DriftDataError(f"{name} feature {c} must be numeric")


def drift_input_counts(
    df: DataFrame, features: Sequence[str] = FEATURES, numeric: Sequence[str] = NUMERIC_FEATURES
) -> DataFrame:
    """Rows, and per feature the values that rule it out (non-finite number, null category)."""
    numeric = set(numeric)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[count_where(non_finite(c) if c in numeric else F.col(c).isNull()).alias(f"bad__{c}")
          for c in features],
    )
    return counts.select("rows", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"bad__{c}").alias("bad_values")) for c in features
    ])))


def require_drift_input(
    df: DataFrame, name: str = "data",
    features: Sequence[str] = FEATURES, numeric: Sequence[str] = NUMERIC_FEATURES,
) -> int:
    """The number of rows, or an error naming the feature that cannot be compared."""
    _check_drift_schema(df, name, features, numeric)
    found = drift_input_counts(df, features, numeric).collect()
    if found[0].rows == 0:
        raise DriftDataError(f"{name} table is empty")
    for r in found:
        if r.bad_values:
            what = "non-finite values" if r.feature in numeric else "missing values"
            raise DriftDataError(f"{name} feature {r.feature} contains {what}")
    return found[0].rows


def scored_sanity(scored: DataFrame, score: str, decision: str | None = None) -> DataFrame:
    """Counts of scores that are missing, NaN, infinite or outside [0, 1]."""
    p = F.col(score).cast("double")
    outside = F.coalesce(~F.isnan(p) & ((p < 0) | (p > 1)), F.lit(False))
    bad_decision = F.col(decision).isNull() if decision else F.lit(False)
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        count_where(non_finite(score)).alias("non_finite"),
        count_where(outside).alias("outside_unit_interval"),
        count_where(bad_decision).alias("missing_decisions"),
    ).withColumn("valid", (F.col("rows") > 0) & (
        (F.col("non_finite") + F.col("outside_unit_interval") + F.col("missing_decisions")) == 0
    ))


def lost_rows(inputs: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """Input keys that have no score, and scored keys given more than once."""
    per_key = (
        inputs.select(key).groupBy(key).agg(F.count("*").alias("expected"))
        .join(scored.groupBy(key).agg(F.count("*").alias("found")), key, "left")
    )
    return per_key.select(key, "expected", F.coalesce("found", F.lit(0)).alias("found")).where(
        "expected <> found"
    )
