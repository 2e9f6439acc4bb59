"""Cleaning and feature projection: no shuffle, one codegen stage, streamable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskspark.config import DROPPED_COLUMNS, FeatureConfig
from riskspark.errors import MissingTargetError
from riskspark.functions import count_where


def add_features(df: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Append the derived features whose inputs exist and whose switch is on."""
    derived = {}
    if config.balance_diffs:
        if {"oldbalanceOrg", "newbalanceOrig"} <= set(df.columns):
            derived["balance_diff_orig"] = F.col("oldbalanceOrg") - F.col("newbalanceOrig")
        if {"newbalanceDest", "oldbalanceDest"} <= set(df.columns):
            derived["balance_diff_dest"] = F.col("newbalanceDest") - F.col("oldbalanceDest")
    if config.amount_ratio and {"amount", "oldbalanceOrg"} <= set(df.columns):
        derived["amount_to_balance_ratio"] = F.try_divide(
            F.col("amount"), F.col("oldbalanceOrg") + F.lit(1.0)
        )
    return df.withColumns(derived) if derived else df


def require_target(df: DataFrame, target: str = "isFraud") -> DataFrame:
    if target not in df.columns:
        raise MissingTargetError(f"target column {target!r} is absent")
    return df


def preprocess(
    df: DataFrame,
    target: str = "isFraud",
    drop: Sequence[str] = DROPPED_COLUMNS,
    categorical: Sequence[str] = ("type",),
) -> DataFrame:
    """Drop the configured columns that exist and hold categories as strings."""
    kept = require_target(df.drop(*drop), target)
    return kept.withColumns(
        {c: F.col(c).cast("string") for c in categorical if c in kept.columns}
    )


def clean(
    df: DataFrame,
    target: str = "isFraud",
    features: FeatureConfig = FeatureConfig(),
    drop: Sequence[str] = DROPPED_COLUMNS,
) -> DataFrame:
    """Features first, then the drop: raw 11 columns in, 10 out."""
    return df.transform(add_features, features).transform(preprocess, target, drop)


def with_row_key(df: DataFrame, out: str = "row_key") -> DataFrame:
    """A key from the row's own content, for tables without an id; equal rows share it,
    so a split by it keeps copies on one side."""
    return df.withColumn(out, F.md5(F.to_json(F.struct(*df.columns))))


def features_and_target(df: DataFrame, target: str = "isFraud") -> tuple[list[str], str]:
    """Names of the feature columns (all but the target) and of the target."""
    require_target(df, target)
    return [c for c in df.columns if c != target], target


def stage_report(before: DataFrame, after: DataFrame, stage: str) -> DataFrame:
    """Shape in, shape out and column changes, with the rows of both sides counted."""
    removed = [c for c in before.columns if c not in after.columns]
    created = [c for c in after.columns if c not in before.columns]
    counted = before.select(F.lit(0).alias("side")).unionByName(after.select(F.lit(1).alias("side"))).agg(
        count_where(F.col("side") == 0).alias("input_rows"), count_where(F.col("side") == 1).alias("output_rows"))
    return counted.select(
        F.lit(stage).alias("stage"),
        "input_rows",
        F.lit(len(before.columns)).alias("input_columns"),
        "output_rows",
        F.lit(len(after.columns)).alias("output_columns"),
        F.lit(",".join(removed)).alias("features_removed"),
        F.lit(",".join(created)).alias("features_created"),
        F.lit(",".join(after.columns)).alias("final_columns"),
        F.when(F.col("output_rows") > 0, "SUCCESS").otherwise("EMPTY").alias("status"),
    )
