"""Request-log series on a stream.

Rows first collapse into panes that divide window and slide, and panes into sliding windows, so
the second state store and its shuffle see panes, not log rows.  Rows later than the
watermark are dropped and show up in the query progress.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.config import LATENCY_BUCKETS_MS, OPERATING_THRESHOLD, PROBABILITY_BUCKETS
from riskspark.functions import invalid_score
from riskspark.operators import monitor as O
from riskspark.operators.admission import VIOLATIONS, known_category, with_violations

DELAY = "10 minutes"


def watermarked(log: DataFrame, ts: str = "ts", delay: str = DELAY, key: str | None = "request_id") -> DataFrame:
    """Event time as TIMESTAMP with a watermark; repeated keys within the delay are dropped."""
    timed = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark([key]) if key else timed


def sliding(
    timed: DataFrame, sums: dict[str, Column], by: Sequence[str] = (), ts: str = "ts",
    minutes: int = 5, slide: int = 1,
) -> DataFrame:
    """Additive aggregates per closed sliding window (append mode)."""
    by = list(by)
    panes = timed.groupBy(F.window(ts, f"{math.gcd(minutes, slide)} minutes").alias("pane"), *by).agg(
        *[c.alias(n) for n, c in sums.items()]
    )
    windows = panes.groupBy(
        F.window(F.window_time("pane"), f"{minutes} minutes", f"{slide} minutes").alias("w"), *by
    ).agg(*[F.sum(n).alias(n) for n in sums])
    return windows.select(
        *by, *sums, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")
    )


def request_series(log: DataFrame, delay: str = DELAY, minutes: int = 5, slide: int = 1) -> DataFrame:
    """Request rate and error rate per window."""
    windows = sliding(watermarked(log, delay=delay), O.request_sums(), minutes=minutes, slide=slide)
    return O.add_error_rate(O.add_request_rate(windows, minutes))


def fraud_series(
    log: DataFrame, threshold: float = OPERATING_THRESHOLD, delay: str = DELAY, minutes: int = 5, slide: int = 1
) -> DataFrame:
    """Fraud and non-fraud predictions and the fraud rate per window."""
    timed = watermarked(log, delay=delay).where(F.col("probability").isNotNull())
    return O.add_fraud_rate(sliding(timed, O.prediction_sums(threshold), minutes=minutes, slide=slide))


def latency_series(
    log: DataFrame, q: float = 0.95, bounds: Sequence[float] = LATENCY_BUCKETS_MS,
    delay: str = DELAY, minutes: int = 5, slide: int = 1,
) -> DataFrame:
    """Latency quantile per window, from bucket counts."""
    windows = sliding(watermarked(log, delay=delay), O.latency_sums(bounds), minutes=minutes, slide=slide)
    return O.add_latency_quantile(windows, q, bounds)


def probability_series(
    log: DataFrame, bounds: Sequence[float] = PROBABILITY_BUCKETS, delay: str = DELAY,
    minutes: int = 5, slide: int = 1,
) -> DataFrame:
    """Predictions per window and probability bucket."""
    timed = watermarked(log, delay=delay).where(~invalid_score("probability"))
    rows = timed.withColumn("le", O.bucket_label(F.col("probability"), bounds))
    return sliding(rows, {"predictions": F.count(F.lit(1))}, ["le"], minutes=minutes, slide=slide)


def quality_series(
    requests: DataFrame, ts: str = "ts", delay: str = DELAY, minutes: int = 5, slide: int = 1
) -> DataFrame:
    """Admission violations per window and category.

    All requests move the watermark. Those without a violation stay in the plan until then: dropped
    when violations are unrolled, they would be filtered before it, and a stream of good requests
    would never close the window of a bad one.
    """
    timed = with_violations(watermarked(requests, ts, delay, key=None))
    rows = timed.select(ts, F.inline_outer(VIOLATIONS)).where(F.col("category").isNotNull())
    rows = rows.withColumn("category", known_category(F.col("category")))
    return sliding(rows, {"errors": F.count(F.lit(1))}, ["category"], ts, minutes, slide)
