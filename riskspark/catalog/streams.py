"""Streaming runs over the event file; closed windows must equal the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.catalog.drift import drift_views
from riskspark.catalog.monitoring import PLACE, WINDOW, fraud_rate_sql, latency_quantile_sql, sliding_sql, spoiled
from riskspark.catalog.shape import rounded
from riskspark.catalog.tables_sql import TABLES, VIOLATIONS
from riskspark.operators import features as X
from riskspark.operators.metrics import confusion, with_prf
from riskspark.session import scratch_path
from riskspark.sources import testdata as D
from riskspark.streaming import drift as SD, labels as SL, monitor as SM, scoring as SS
from riskspark.streaming.run import write_stream

# a window is closed once the watermark (latest event - 10 minutes) has passed its end
CLOSED = "HAVING w.window_start + to_minutes(5) <= (SELECT max(ts) - to_minutes(10) FROM {source})"


def _run(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Drive the stream until it has caught up and read what it wrote."""
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    write_stream(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def events(spark, sf):
    return D.stream_events(spark, sf, only="events.parquet")


def requests(spark, sf):
    return D.requests_from(events(spark, sf))


def _text_requests(stream):
    return D.score_requests_from(D.transactions_from(stream))


def quality(spark, sf):
    return rounded(_run(spark, SM.quality_series(_text_requests(events(spark, sf))), "dq"))


def admission(spark, sf):
    """Admitted and quarantined requests, written by two stateless streams."""
    valid = _run(spark, SS.admitted(_text_requests(events(spark, sf))).select("txn_id"), "admitted")
    bad = _run(spark, SS.quarantined(_text_requests(events(spark, sf))).select("txn_id"), "quarantined")
    return valid.select("txn_id", F.lit(True).alias("valid")).unionByName(bad.select("txn_id", F.lit(False).alias("valid")))


def labels(spark, sf):
    t = D.transactions_from(events(spark, sf))
    scored = D.scored_from(t).select("txn_id", "ts", F.col("p_candidate").alias("p"))
    late = D.late_labels_from(D.transactions_from(events(spark, sf)))
    joined = _run(spark, SL.label_join(scored, late), "labels")
    return rounded(with_prf(confusion(joined, 0.9)))


def drift(spark, sf):
    """The second half of the month as one micro-batch against the first half."""
    featured = X.add_features(D.transactions_from(events(spark, sf)))
    reference = X.add_features(D.transactions(spark, sf)).where("step <= 360")
    out, checkpoint = scratch_path(spark, "drift"), scratch_path(spark, "drift-checkpoint")
    SD.run_drift(featured.where("step > 360"), reference, out, checkpoint).awaitTermination()
    return rounded(spark.read.parquet(out).select("feature", "method", "drift_score", "drift_detected", "rows"))


_PREDICTED = "WHERE probability IS NOT NULL"

QUERIES = {
    "stream_rate_5m": (
        lambda s, sf: rounded(_run(s, SM.request_series(requests(s, sf)), "rate")),
        TABLES + sliding_sql() + f"""SELECT {WINDOW}, count(*) AS requests, count(*) FILTER (WHERE status >= 400) AS errors,
        round(CAST(count(*) AS DOUBLE) / 300, 6) AS requests_per_second,
        round(CAST(count(*) FILTER (WHERE status >= 400) AS DOUBLE) / count(*), 6) AS error_rate FROM w GROUP BY w.window_start """
        + CLOSED.format(source="requests"),
    ),
    "stream_fraud_rate_5m": (
        lambda s, sf: rounded(_run(s, SM.fraud_series(requests(s, sf)), "fraud")),
        fraud_rate_sql(having=CLOSED.format(source="requests")),
    ),
    "stream_fraud_rate_5m_spoiled": (
        lambda s, sf: rounded(_run(s, SM.fraud_series(spoiled(requests(s, sf))), "fraud-spoiled")),
        fraud_rate_sql(True, CLOSED.format(source="requests")),
    ),
    "stream_p95_latency_5m": (
        lambda s, sf: rounded(_run(s, SM.latency_series(requests(s, sf)), "latency")),
        latency_quantile_sql(0.95, CLOSED.format(source="requests")),
    ),
    "stream_prob_heatmap": (
        lambda s, sf: rounded(_run(s, SM.probability_series(requests(s, sf)), "heatmap")),
        TABLES + sliding_sql(extra=_PREDICTED) + f"SELECT {WINDOW}, {PLACE} AS le, count(*) AS predictions FROM w GROUP BY w.window_start, le "
        + CLOSED.format(source="requests"),
    ),
    "stream_dq_errors_5m": (
        quality,
        TABLES + VIOLATIONS + ", vt AS (SELECT v.category, t.ts FROM violations v JOIN transactions t ON t.txn_id = v.txn_id)"
        + sliding_sql("vt") + f"SELECT {WINDOW}, category, count(*) AS errors FROM w GROUP BY w.window_start, category "
        + CLOSED.format(source="transactions"),
    ),
    "stream_admission": (
        admission,
        TABLES + VIOLATIONS + "SELECT txn_id, txn_id NOT IN (SELECT txn_id FROM violations) AS valid FROM dirty",
    ),
    "stream_label_join": (
        labels,
        TABLES + """, c AS (SELECT count(*) FILTER (WHERE y = 0 AND p_candidate < 0.9) AS tn, count(*) FILTER (WHERE y = 0 AND p_candidate >= 0.9) AS fp,
          count(*) FILTER (WHERE y = 1 AND p_candidate < 0.9) AS fn, count(*) FILTER (WHERE y = 1 AND p_candidate >= 0.9) AS tp,
          count(*) FILTER (WHERE NOT coalesce(p_candidate >= 0 AND p_candidate <= 1, FALSE)) AS invalid_scores
          FROM scored WHERE txn_id % 5 <> 0)
        SELECT *, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 6) AS recall,
        round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score FROM c""",
    ),
    "stream_drift": (
        drift,
        TABLES + drift_views("SELECT * FROM featured WHERE step <= 360", "SELECT * FROM featured WHERE step > 360")
        + """SELECT feature, method, round(drift_score, 6) AS drift_score, drift_score >= 0.1 AS drift_detected, (SELECT count(*) FROM cur) AS rows FROM feat""",
    ),
}
