"""Distribution drift between a reference and a current table.

All numeric features are compared in one pass: unpivoted to (feature, value, side), tied
values collapsed, and both empirical distributions accumulated by ``ordered_cumsum``.
Categories need counts only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskspark.config import DriftConfig
from riskspark.functions import at_or_above, count_where, invalid_score, is_missing
from riskspark.operators.admission import require_drift_input
from riskspark.plans import SKETCH_SHARE, as_literal, ordered_cumsum, sketch

# Below this a Kolmogorov p-value is 1 to double precision.
KOLMOGOROV_ONE = 0.04
MIN_STD = 0.001


def _sides(reference: DataFrame, current: DataFrame, entries) -> DataFrame:
    return reference.select(F.inline(F.array(*entries)), F.lit(0).alias("side")).unionByName(
        current.select(F.inline(F.array(*entries)), F.lit(1).alias("side"))
    )


def numeric_distances(
    reference: DataFrame, current: DataFrame, features: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """Per feature: rows of both sides, Wasserstein-1 distance, the same divided by the
    reference's standard deviation, and the Kolmogorov-Smirnov statistic."""
    # features travel as small integers: cheaper to shuffle and sort than their names
    entries = [
        F.struct(F.lit(i).alias("feature"), F.col(f).cast("double").alias("value"))
        for i, f in enumerate(features, 1)
    ]
    name = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    long = _sides(reference, current, entries)
    # cut points from sampled rows, taken before each row becomes one row per feature
    sampled = _sides(*(df.sample(SKETCH_SHARE, seed=42) for df in (reference, current)), entries)
    cuts = sketch(sampled, "value", buckets, share=1.0, seen=SKETCH_SHARE)
    # each side is read once more, exploded and shuffled; totals, spread and distances read what that wrote
    table = ordered_cumsum(
        long, "value",
        {"ref": 1 - F.col("side"), "cur": F.col("side")}, ["feature"], cuts=cuts, store=True,
    )
    value, ref = F.col("value"), F.col("ref").cast("double")
    # one row per feature
    means = as_literal(table.groupBy("feature").agg(F.try_divide(F.sum(value * ref), F.sum(ref)).alias("mean")))
    gap = F.abs(
        F.col("cum_ref").cast("double") / F.col("total_ref")
        - F.col("cum_cur").cast("double") / F.col("total_cur")
    )
    off = value - F.col("mean")
    return table.where((F.col("total_ref") > 0) & (F.col("total_cur") > 0)).join(F.broadcast(means), "feature").groupBy("feature").agg(
        F.max("total_ref").alias("reference_rows"), F.max("total_cur").alias("current_rows"),
        F.sum(gap * F.coalesce(F.col("next_value") - value, F.lit(0.0))).alias("wasserstein"),
        F.max(gap).alias("ks"),
        F.sqrt(F.sum(off * off * ref) / F.max("total_ref")).alias("std"),
    ).withColumn("feature", name).withColumn(
        "normed_wasserstein", F.col("wasserstein") / F.greatest(F.col("std"), F.lit(MIN_STD))
    )


def category_counts(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, category, ref, cur, total_ref, total_cur)."""
    entries = [
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("category")) for f in features
    ]
    counts = _sides(reference, current, entries).groupBy("feature", "category").agg(
        count_where(F.col("side") == 0).alias("ref"), count_where(F.col("side") == 1).alias("cur")
    )
    totals = counts.groupBy("feature").agg(F.sum("ref").alias("total_ref"), F.sum("cur").alias("total_cur"))
    # one row per feature, however many categories
    return counts.join(F.broadcast(totals), "feature")


def categorical_distances(
    reference: DataFrame, current: DataFrame, features: Sequence[str], log_base: float = math.e
) -> DataFrame:
    """Per feature: Jensen-Shannon distance, and the chi-square statistic of the current
    counts against the reference shares with its degrees of freedom."""
    return distances_of_counts(category_counts(reference, current, features), log_base)


def distances_of_counts(counts: DataFrame, log_base: float = math.e) -> DataFrame:
    """``categorical_distances`` from ``category_counts``."""
    p = F.col("ref").cast("double") / F.col("total_ref")
    q = F.col("cur").cast("double") / F.col("total_cur")
    m = (p + q) / F.lit(2.0)

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.ln(x / m)).otherwise(F.lit(0.0))

    expected = p * F.col("total_cur")
    chi = F.when(expected > 0, (F.col("cur") - expected) * (F.col("cur") - expected) / expected).when(
        F.col("cur") > 0, F.lit(float("inf"))
    ).otherwise(F.lit(0.0))
    return counts.groupBy("feature").agg(
        F.max("total_ref").alias("reference_rows"), F.max("total_cur").alias("current_rows"),
        F.sqrt(F.greatest(F.sum(part(p) + part(q)) / F.lit(2.0 * math.log(log_base)), F.lit(0.0)))
        .alias("jensen_shannon"),
        F.sum(chi).alias("chi_square"),
        (F.count("*") - 1).alias("df"),
    )


# --- p-values: one row per feature ---------------------------------------------------

def ks_p_value(ks: Column, n: Column, m: Column) -> Column:
    """Two-sample Kolmogorov-Smirnov p-value by the asymptotic series."""
    x = ks * F.sqrt(n.cast("double") * m.cast("double") / (n + m).cast("double"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(F.lit(-2.0) * j * j * x * x),
    )
    return F.when(x < KOLMOGOROV_ONE, F.lit(1.0)).otherwise(
        F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    )


def chi_square_upper_tail(x: float, df: int) -> float:
    """P(X > x) for a chi-square variable, by the finite sums for even and odd df."""
    if df < 1:
        return 1.0
    if math.isinf(x):
        return 0.0
    if x <= 0:
        return 1.0
    # terms half^a e^-half / gamma(a + 1) for a = 0, 1, ... or 0.5, 1.5, ...; summed from their
    # logarithms, as e^-half alone is 0 for a large statistic
    half, odd = x / 2.0, df % 2
    powers = [a + odd / 2.0 for a in range((df - odd) // 2)]
    logs = [a * math.log(half) - half - math.lgamma(a + 1.0) for a in powers]
    top = max(logs, default=0.0)
    total = math.exp(top) * math.fsum(math.exp(v - top) for v in logs)
    return min(1.0, total + (math.erfc(math.sqrt(half)) if odd else 0.0))


@F.pandas_udf(T.DoubleType())
def chi_square_p_value(x: pd.Series, df: pd.Series) -> pd.Series:
    """Runs on one row per categorical feature."""
    return pd.Series([chi_square_upper_tail(a, int(b)) for a, b in zip(x, df)], dtype="float64")


# --- verdicts --------------------------------------------------------------------------

def feature_drift(
    reference: DataFrame, current: DataFrame, config: DriftConfig = DriftConfig(), method: str = "distance"
) -> DataFrame:
    """One row per feature: method, score, threshold and whether it drifted.

    Distances drift at or above their threshold, p-values below theirs.
    """
    return verdicts(
        numeric_distances(reference, current, config.numeric),
        categorical_distances(reference, current, config.categorical, config.log_base), config, method,
    )


def verdicts(numeric: DataFrame, categorical: DataFrame, config: DriftConfig = DriftConfig(), method: str = "distance") -> DataFrame:
    """``feature_drift`` from the distances of both kinds of features."""
    if method == "p_value":
        parts = [
            numeric.select("feature", F.lit("ks_p_value").alias("method"),
                           ks_p_value(F.col("ks"), F.col("reference_rows"), F.col("current_rows")).alias("drift_score")),
            categorical.select("feature", F.lit("chi_square_p_value").alias("method"),
                               chi_square_p_value("chi_square", "df").alias("drift_score")),
        ]
        threshold = config.p_value_threshold
        drifted = F.col("drift_score") < threshold
    elif method == "distance":
        parts = [
            numeric.select("feature", F.lit("normed_wasserstein").alias("method"),
                           F.col("normed_wasserstein").alias("drift_score")),
            categorical.select("feature", F.lit("jensen_shannon").alias("method"),
                               F.col("jensen_shannon").alias("drift_score")),
        ]
        threshold = config.distance_threshold
        drifted = ~F.isnan("drift_score") & (F.col("drift_score") >= threshold)
    else:
        raise ValueError(f"unknown drift method {method!r}")
    return parts[0].unionByName(parts[1]).withColumn("drift_threshold", F.lit(float(threshold))).withColumn(
        "drift_detected", F.coalesce(drifted, F.lit(False))
    )


def drift_summary(per_feature: DataFrame, config: DriftConfig = DriftConfig()) -> DataFrame:
    """The dataset verdict: share of drifted features against the share threshold."""
    features = len(config.numeric) + len(config.categorical)
    return per_feature.agg(
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))), ",")
        .alias("drifted_features"),
        count_where(F.col("drift_detected")).alias("drifted"),
    ).withColumn("drift_share", F.col("drifted") / F.lit(float(features))).withColumns({
        "drift_share_threshold": F.lit(float(config.share_threshold)),
        "dataset_drift_detected": F.col("drift_share") >= F.lit(float(config.share_threshold)),
        "investigation_required": F.col("drifted") > 0,
    })


def missing_counts(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Missing values per feature on both sides, one aggregation each."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(*[count_where(is_missing(f, df.schema[f].dataType)).alias(f) for f in features]).select(
            F.inline(F.array(*[
                F.struct(F.lit(f).alias("feature"), F.col(f).alias(name)) for f in features
            ]))
        )

    return side(reference, "reference_missing").join(side(current, "current_missing"), "feature")


def compare(
    reference: DataFrame, current: DataFrame, config: DriftConfig = DriftConfig(), method: str = "distance"
) -> tuple[DataFrame, DataFrame]:
    """Check both tables, then (per-feature results, one-row summary).

    ``method`` is "distance" or "p_value"; the size of the tables has no say in it.
    """
    features = [*config.categorical, *config.numeric]
    reference_rows = require_drift_input(reference, "reference", features, config.numeric)
    current_rows = require_drift_input(current, "current", features, config.numeric)
    per_feature = feature_drift(reference, current, config, method)
    summary = drift_summary(per_feature, config).withColumns({
        "reference_rows": F.lit(reference_rows), "current_rows": F.lit(current_rows),
    })
    return per_feature, summary


def score_drift(
    reference: DataFrame, current: DataFrame, score: str, threshold: float, config: DriftConfig = DriftConfig()
) -> DataFrame:
    """Drift of the predicted probability and of the decision made from it.

    Scores that are no probability are compared in neither; each row tells how many either side has.
    """
    def with_decision(df: DataFrame) -> DataFrame:
        return df.where(~invalid_score(score)).select(
            F.col(score).alias("probability"),
            F.when(at_or_above(F.col(score), threshold), "fraud").otherwise("non_fraud").alias("decision"),
        )

    def invalid(df: DataFrame, name: str) -> DataFrame:
        return df.agg(count_where(invalid_score(score)).alias(name))

    only = DriftConfig(
        numeric=("probability",), categorical=("decision",),
        distance_threshold=config.distance_threshold, share_threshold=config.share_threshold,
    )
    # two tables of one row
    counts = invalid(reference, "reference_invalid_scores").join(F.broadcast(invalid(current, "current_invalid_scores")))
    return feature_drift(with_decision(reference), with_decision(current), only).join(F.broadcast(counts))
