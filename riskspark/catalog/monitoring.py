"""Operational aggregates over the request log."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog.shape import rounded
from riskspark.catalog.tables_sql import TABLES, VIOLATIONS
from riskspark.config import LATENCY_BUCKETS_MS, PROBABILITY_BUCKETS
from riskspark.operators import admission as A, monitor as O
from riskspark.operators.train import decide
from riskspark.sources import testdata as D

LOG = D.requests
LABELS_PROB = [f"{b:g}" for b in PROBABILITY_BUCKETS]
LABELS_LAT = [f"{b:g}" for b in LATENCY_BUCKETS_MS]


def sliding_sql(source: str = "requests", extra: str = "") -> str:
    return f""",
w AS (SELECT date_trunc('minute', ts) - to_minutes(CAST(k AS BIGINT)) AS window_start, r.* FROM {source} r CROSS JOIN range(5) g(k) {extra})
"""


def uneven_sql(minutes: int, slide: int, source: str = "requests") -> str:
    """Every row in each window of ``minutes`` that starts at a multiple of ``slide`` minutes."""
    return f""",
w AS (SELECT * FROM (
  SELECT make_timestamp(((epoch(date_trunc('minute', ts))::BIGINT // {60 * slide}) - k) * {60 * slide} * 1000000) AS window_start, r.*
  FROM {source} r CROSS JOIN range({-(-minutes // slide)}) g(k)) WHERE ts < window_start + to_minutes({minutes}))
"""


WINDOW = "CAST(window_start AS VARCHAR) AS window_start, CAST(window_start + to_minutes(5) AS VARCHAR) AS window_end"


#: Scores and latencies that are none, spread over the log: what the rules must leave out and report.
SPOILED = """, spoiled AS (SELECT * REPLACE (
  CASE request_id % 40 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 1.5 WHEN 2 THEN 'Infinity'::DOUBLE WHEN 3 THEN -0.25 WHEN 4 THEN NULL
    ELSE probability END AS probability,
  CASE request_id % 37 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN NULL WHEN 2 THEN '-Infinity'::DOUBLE ELSE latency_ms END AS latency_ms) FROM requests),
valid AS (SELECT * REPLACE (CASE WHEN isfinite(probability) AND probability BETWEEN 0 AND 1 THEN probability END AS probability,
  CASE WHEN isfinite(latency_ms) THEN latency_ms END AS latency_ms),
  CAST(probability IS NOT NULL AND NOT (isfinite(probability) AND probability BETWEEN 0 AND 1) AS INT) AS invalid FROM spoiled)
"""


def spoiled(log):
    k, nan, inf = F.col("request_id"), F.lit(float("nan")), F.lit(float("inf"))
    p = F.when(k % 40 == 0, nan).when(k % 40 == 1, 1.5).when(k % 40 == 2, inf).when(k % 40 == 3, -0.25)
    t = F.when(k % 37 == 0, nan).when(k % 37 == 2, -inf)
    return log.withColumns({"probability": p.when(k % 40 != 4, F.col("probability")), "latency_ms": t.when(k % 37 != 1, F.col("latency_ms"))})


def _histogram(value: str, bounds, labels, source: str = "requests", beside: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS le, count(*) FILTER (WHERE {value} <= {b}) AS cumulative{beside} FROM {source}" for label, b in zip(labels, bounds)
    ) + f" UNION ALL SELECT '+Inf', count({value}){beside} FROM {source}"


def _summary(source: str, invalid: str) -> str:
    return f"""SELECT count(probability) AS total, count(*) FILTER (WHERE probability >= 0.9) AS fraud, count(*) FILTER (WHERE probability < 0.9) AS non_fraud,
        round(avg(probability), 6) AS average_probability, round(min(probability), 6) AS min_probability, round(max(probability), 6) AS max_probability,
        count(*) FILTER (WHERE probability < 0.9) AS below_threshold, count(*) FILTER (WHERE probability >= 0.9) AS at_or_above_threshold,
        {invalid} AS invalid_scores,
        round(CAST(count(*) FILTER (WHERE probability >= 0.9) AS DOUBLE) / count(probability), 6) AS fraud_rate FROM {source}"""


NO_INVALID = "CAST(0 AS BIGINT)"


def fraud_rate_sql(spoilt: bool = False, having: str = "") -> str:
    """Rates per window; over the spoiled log a window may hold invalid scores only."""
    source, count = ("valid", "CAST(sum(invalid) AS BIGINT)") if spoilt else ("requests", NO_INVALID)
    where = "WHERE probability IS NOT NULL" + (" OR invalid = 1" if spoilt else "")
    return TABLES + (SPOILED if spoilt else "") + sliding_sql(source, where) + f"""SELECT {WINDOW}, count(*) FILTER (WHERE probability >= 0.9) AS fraud,
        count(*) FILTER (WHERE probability < 0.9) AS non_fraud, {count} AS invalid_scores,
        round(CAST(count(*) FILTER (WHERE probability >= 0.9) AS DOUBLE) / greatest(CAST(count(probability) AS DOUBLE), 1e-9), 6) AS fraud_rate FROM w GROUP BY w.window_start {having}"""


def latency_quantile_sql(q: float, having: str = "") -> str:
    bounds = list(LATENCY_BUCKETS_MS)
    counts = ", ".join(f"count(*) FILTER (WHERE latency_ms <= {b}) AS c{i}" for i, b in enumerate(bounds))
    cases = " ".join(
        f"WHEN c{i} >= rnk THEN {bounds[i - 1] if i else 0.0}::DOUBLE + ({b} - {bounds[i - 1] if i else 0.0})::DOUBLE * "
        f"coalesce((rnk - {f'c{i - 1}' if i else '0'}) / nullif(CAST(c{i} - {f'c{i - 1}' if i else '0'} AS DOUBLE), 0), 0)"
        for i, b in enumerate(bounds)
    )
    return TABLES + sliding_sql() + f""", h AS (SELECT window_start, count(latency_ms) AS n, {counts} FROM w GROUP BY w.window_start {having}),
    r AS (SELECT *, CAST(n AS DOUBLE) * {q} AS rnk FROM h)
    SELECT {WINDOW}, n AS requests, round(CASE WHEN n = 0 THEN NULL {cases} ELSE {bounds[-1]}::DOUBLE END, 6) AS quantile_ms FROM r"""


PLACE = "CASE " + " ".join(f"WHEN probability <= {b} THEN '{x}'" for b, x in zip(PROBABILITY_BUCKETS, LABELS_PROB)) + " ELSE '+Inf' END"


def dq_over_time(s, sf):
    return O.quality_errors_over_time(A.violations_long(D.score_requests(s, sf), ["ts"]))


def online(s, sf):
    t = D.transactions(s, sf)
    scored = D.scored_from(t).select("txn_id", "ts", F.col("p_candidate").alias("p"))
    return O.online_performance(scored, D.late_labels_from(t))


QUERIES = {
    "req_totals": (
        lambda s, sf: rounded(O.request_totals(LOG(s, sf))),
        TABLES + """SELECT count(*) AS total, count(*) FILTER (WHERE status >= 400) AS errors,
        round(CAST(count(*) FILTER (WHERE status >= 400) AS DOUBLE) / count(*), 6) AS error_rate FROM requests""",
    ),
    "req_by_endpoint": (
        lambda s, sf: O.requests_by_endpoint(LOG(s, sf)),
        TABLES + "SELECT concat(method, ' ', path) AS endpoint, count(*) AS requests FROM requests GROUP BY 1",
    ),
    "req_by_status": (
        lambda s, sf: O.requests_by_status(LOG(s, sf)),
        TABLES + "SELECT CAST(status AS VARCHAR) AS status, count(*) AS requests FROM requests GROUP BY 1",
    ),
    "latency_summary": (
        lambda s, sf: rounded(O.latency_summary(LOG(s, sf))),
        TABLES + """SELECT count(latency_ms) AS count, round(avg(latency_ms), 6) AS average_ms, round(min(latency_ms), 6) AS min_ms,
        round(max(latency_ms), 6) AS max_ms FROM requests""",
    ),
    "prediction_summary": (
        lambda s, sf: rounded(O.prediction_summary(LOG(s, sf))),
        TABLES + _summary("requests", NO_INVALID),
    ),
    "prediction_summary_spoiled": (
        lambda s, sf: rounded(O.prediction_summary(spoiled(LOG(s, sf)))),
        TABLES + SPOILED + _summary("valid", "CAST(sum(invalid) AS BIGINT)"),
    ),
    "latency_summary_spoiled": (
        lambda s, sf: rounded(O.latency_summary(spoiled(LOG(s, sf)))),
        TABLES + SPOILED + """SELECT count(latency_ms) AS count, round(avg(latency_ms), 6) AS average_ms, round(min(latency_ms), 6) AS min_ms,
        round(max(latency_ms), 6) AS max_ms FROM valid""",
    ),
    "prob_histogram_spoiled": (
        lambda s, sf: O.probability_histogram(spoiled(LOG(s, sf))),
        TABLES + SPOILED + _histogram("probability", PROBABILITY_BUCKETS, LABELS_PROB, "valid", ", CAST(sum(invalid) AS BIGINT) AS invalid_scores"),
    ),
    "fraud_rate_5m_spoiled": (lambda s, sf: rounded(O.fraud_rate(spoiled(LOG(s, sf)))), fraud_rate_sql(spoilt=True)),
    "labelled_requests": (
        lambda s, sf: O.labelled_requests(LOG(s, sf)),
        TABLES + "SELECT method, path AS endpoint, CAST(status AS VARCHAR) AS status, count(*) AS requests FROM requests GROUP BY 1, 2, 3",
    ),
    "error_classes": (
        lambda s, sf: O.error_classes(LOG(s, sf)),
        TABLES + """SELECT method, path AS endpoint, concat(CAST(status // 100 AS VARCHAR), 'xx') AS status_class, count(*) AS errors
        FROM requests WHERE status >= 400 GROUP BY 1, 2, 3""",
    ),
    "decision": (
        lambda s, sf: D.scored(s, sf).select("txn_id", decide(F.col("p_candidate"), 0.9).alias("is_fraud")),
        TABLES + "SELECT txn_id, p_candidate >= 0.9 AS is_fraud FROM scored",
    ),
    "prob_histogram": (lambda s, sf: O.probability_histogram(LOG(s, sf)), TABLES + _histogram(
        "probability", PROBABILITY_BUCKETS, LABELS_PROB, beside=f", {NO_INVALID} AS invalid_scores")),
    "latency_histogram": (lambda s, sf: O.latency_histogram(LOG(s, sf)), TABLES + _histogram("latency_ms", LATENCY_BUCKETS_MS, LABELS_LAT)),
    "rate_5m": (
        lambda s, sf: rounded(O.request_rate(LOG(s, sf))),
        TABLES + sliding_sql() + f"""SELECT {WINDOW}, count(*) AS requests, count(*) FILTER (WHERE status >= 400) AS errors,
        round(CAST(count(*) AS DOUBLE) / 300, 6) AS requests_per_second FROM w GROUP BY w.window_start""",
    ),
    "error_rate_5m": (
        lambda s, sf: rounded(O.error_rate(LOG(s, sf))),
        TABLES + sliding_sql() + f"""SELECT {WINDOW}, count(*) AS requests, count(*) FILTER (WHERE status >= 400) AS errors,
        round(CAST(count(*) FILTER (WHERE status >= 400) AS DOUBLE) / greatest(CAST(count(*) AS DOUBLE), 1e-9), 6) AS error_rate FROM w GROUP BY w.window_start""",
    ),
    "p95_latency_5m": (lambda s, sf: rounded(O.latency_quantile(LOG(s, sf))), latency_quantile_sql(0.95)),
    "p95_latency_exact_1h": (
        lambda s, sf: rounded(O.exact_latency_quantile(LOG(s, sf))),
        TABLES + """SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, count(*) AS requests,
        round(quantile_cont(latency_ms, 0.95), 6) AS quantile_ms FROM requests GROUP BY date_trunc('hour', ts)""",
    ),
    "p95_latency_exact_5m": (
        lambda s, sf: rounded(O.exact_latency_quantile(LOG(s, sf), minutes=5, slide=1)),
        TABLES + sliding_sql() + """SELECT CAST(window_start AS VARCHAR) AS window_start, count(latency_ms) AS requests,
        round(quantile_cont(latency_ms, 0.95), 6) AS quantile_ms FROM w GROUP BY w.window_start""",
    ),
    "rate_5m_every_2m": (
        lambda s, sf: rounded(O.request_rate(LOG(s, sf), 5, 2)),
        TABLES + uneven_sql(5, 2) + """SELECT CAST(window_start AS VARCHAR) AS window_start, CAST(window_start + to_minutes(5) AS VARCHAR) AS window_end,
        count(*) AS requests, count(*) FILTER (WHERE status >= 400) AS errors,
        round(CAST(count(*) AS DOUBLE) / 300, 6) AS requests_per_second FROM w GROUP BY w.window_start""",
    ),
    "fraud_rate_5m": (
        lambda s, sf: rounded(O.fraud_rate(LOG(s, sf))),
        fraud_rate_sql(),
    ),
    "prob_heatmap": (
        lambda s, sf: rounded(O.probability_heatmap(LOG(s, sf))),
        TABLES + sliding_sql(extra="WHERE probability IS NOT NULL") + f"SELECT {WINDOW}, {PLACE} AS le, count(*) AS predictions FROM w GROUP BY w.window_start, le",
    ),
    "dq_errors_5m": (
        lambda s, sf: rounded(dq_over_time(s, sf)),
        TABLES + VIOLATIONS + ", vt AS (SELECT v.category, t.ts FROM violations v JOIN transactions t ON t.txn_id = v.txn_id)"
        + sliding_sql("vt") + f"SELECT {WINDOW}, category, count(*) AS errors FROM w GROUP BY w.window_start, category",
    ),
    "label_join_metrics": (
        lambda s, sf: rounded(online(s, sf).withColumn("day", F.col("day").cast("string"))),
        TABLES + """, l AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, y, p_candidate AS p FROM scored WHERE txn_id % 5 <> 0),
        c AS (SELECT day, count(*) FILTER (WHERE y = 0 AND p < 0.9) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 0.9) AS fp,
          count(*) FILTER (WHERE y = 1 AND p < 0.9) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 0.9) AS tp,
          count(*) FILTER (WHERE NOT coalesce(p >= 0 AND p <= 1, FALSE)) AS invalid_scores FROM l GROUP BY day)
        SELECT *, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 6) AS recall,
        round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score FROM c""",
    ),
}
