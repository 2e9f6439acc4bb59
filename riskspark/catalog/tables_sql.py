"""The table adapters of ``riskspark.sources.testdata`` as SQL over the view ``events``."""

TABLES = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(round(value*100) AS BIGINT) AS amt_c,
    CASE event_type WHEN 'signup' THEN 'CASH_IN' WHEN 'click' THEN 'CASH_OUT' WHEN 'view' THEN 'DEBIT'
                    WHEN 'purchase' THEN 'PAYMENT' ELSE 'TRANSFER' END AS type
  FROM events),
d AS (SELECT *, (type IN ('TRANSFER','CASH_OUT') AND event_id % 11 = 0) AS drain FROM e),
b AS (SELECT *, CASE WHEN drain THEN amt_c ELSE (event_id*7919) % 100000 END AS oo_c,
  CASE WHEN type='PAYMENT' THEN 0 ELSE (event_id*104729) % 200000 END AS od_c FROM d),
transactions AS (
  SELECT event_id AS txn_id, ts,
    CAST((extract(day FROM ts)-1)*24 + extract(hour FROM ts) + 1 AS BIGINT) AS step, type,
    CAST(amt_c AS DOUBLE)/100 AS amount, concat('C', CAST(user_id AS VARCHAR(20))) AS nameOrig,
    CAST(oo_c AS DOUBLE)/100 AS oldbalanceOrg,
    CAST(CASE WHEN type='CASH_IN' THEN oo_c+amt_c ELSE greatest(oo_c-amt_c,0) END AS DOUBLE)/100 AS newbalanceOrig,
    concat(CASE WHEN type='PAYMENT' THEN 'M' ELSE 'C' END, CAST(event_id % 131 AS VARCHAR(20))) AS nameDest,
    CAST(od_c AS DOUBLE)/100 AS oldbalanceDest,
    CAST(CASE WHEN drain THEN od_c ELSE od_c+amt_c END AS DOUBLE)/100 AS newbalanceDest,
    CAST(CASE WHEN drain AND amt_c > 2000 THEN 1 ELSE 0 END AS INT) AS isFraud,
    CAST(CASE WHEN type='TRANSFER' AND amt_c > 20000 THEN 1 ELSE 0 END AS INT) AS isFlaggedFraud
  FROM b),
dirty0 AS (
  SELECT txn_id,
    CASE WHEN txn_id % 523 = 0 THEN 0 ELSE step END AS step,
    CASE WHEN txn_id % 499 = 0 THEN 'UNKNOWN' WHEN txn_id % 491 = 0 THEN NULL ELSE type END AS type,
    CASE WHEN txn_id % 503 = 0 THEN -amount - 1 WHEN txn_id % 509 = 0 THEN NULL ELSE amount END AS amount,
    CASE WHEN txn_id % 563 = 0 THEN 'one hundred' WHEN txn_id % 569 = 0 THEN NULL
         ELSE CAST(CAST(round(amount*100) AS BIGINT) AS VARCHAR(20)) END AS amount_cents_text,
    nameOrig, CASE WHEN txn_id % 521 = 0 THEN CAST(-1 AS DOUBLE) ELSE oldbalanceOrg END AS oldbalanceOrg,
    newbalanceOrig, nameDest, oldbalanceDest, newbalanceDest,
    CASE WHEN txn_id % 541 = 0 THEN 2 WHEN txn_id % 547 = 0 THEN NULL ELSE isFraud END AS isFraud, isFlaggedFraud
  FROM transactions),
dirty AS (SELECT * FROM dirty0 UNION ALL SELECT * FROM dirty0 WHERE txn_id % 557 = 0),
scored AS (
  SELECT txn_id, ts, type, isFraud AS y,
    CAST(((txn_id*7919) % 700) + 300*isFraud AS DOUBLE)/1000 AS p_candidate,
    CAST(((txn_id*6007) % 800) + 200*isFraud AS DOUBLE)/1000 AS p_champion
  FROM transactions),
requests AS (
  SELECT e.event_id AS request_id, e.ts,
    CASE WHEN e.event_type IN ('view','signup') THEN 'GET' ELSE 'POST' END AS method,
    CASE e.event_type WHEN 'view' THEN '/health' WHEN 'signup' THEN '/model-info' ELSE '/predict' END AS path,
    CAST(CASE WHEN e.event_type <> 'error' THEN 200 WHEN e.event_id % 3 = 0 THEN 422
              WHEN e.event_id % 3 = 1 THEN 500 ELSE 503 END AS INT) AS status,
    e.value AS latency_ms,
    CASE WHEN e.event_type IN ('click','purchase') THEN s.p_candidate END AS probability
  FROM e JOIN scored s ON s.txn_id = e.event_id),
featured AS (
  SELECT *, oldbalanceOrg - newbalanceOrig AS balance_diff_orig,
    newbalanceDest - oldbalanceDest AS balance_diff_dest,
    amount / (oldbalanceOrg + CAST(1 AS DOUBLE)) AS amount_to_balance_ratio
  FROM transactions)
"""

# --- follow-on views, appended where a query needs them ---------------------------------

VIOLATIONS = """,
checked AS (
  SELECT *, CASE WHEN amount_cents_text = 'one hundred' THEN amount_cents_text
                 ELSE CAST(amount AS VARCHAR) END AS amount_text FROM dirty),
fields AS (
  SELECT txn_id, 'type' AS field, 'invalid_type' AS bad, type AS raw,
    CASE WHEN type IS NULL OR type IN ('CASH_IN','CASH_OUT','DEBIT','PAYMENT','TRANSFER') THEN 1 ELSE 0 END AS ok FROM checked
  UNION ALL SELECT txn_id, 'amount', 'invalid_amount', amount_text,
    CASE WHEN TRY_CAST(amount_text AS DOUBLE) >= 0 THEN 1 ELSE 0 END FROM checked
  UNION ALL SELECT txn_id, 'oldbalanceOrg', 'invalid_balance', CAST(oldbalanceOrg AS VARCHAR),
    CASE WHEN oldbalanceOrg >= 0 THEN 1 ELSE 0 END FROM checked
  UNION ALL SELECT txn_id, 'newbalanceOrig', 'invalid_balance', CAST(newbalanceOrig AS VARCHAR),
    CASE WHEN newbalanceOrig >= 0 THEN 1 ELSE 0 END FROM checked
  UNION ALL SELECT txn_id, 'oldbalanceDest', 'invalid_balance', CAST(oldbalanceDest AS VARCHAR),
    CASE WHEN oldbalanceDest >= 0 THEN 1 ELSE 0 END FROM checked
  UNION ALL SELECT txn_id, 'newbalanceDest', 'invalid_balance', CAST(newbalanceDest AS VARCHAR),
    CASE WHEN newbalanceDest >= 0 THEN 1 ELSE 0 END FROM checked),
violations AS (
  SELECT txn_id, field, CASE WHEN raw IS NULL THEN 'missing_field' ELSE bad END AS category
  FROM fields WHERE raw IS NULL OR ok = 0)
"""

LONG_SCORES = """,
long_scores AS (
  SELECT 'candidate' AS experiment, txn_id, type, ts, y, p_candidate AS p FROM scored
  UNION ALL SELECT 'champion', txn_id, type, ts, y, p_champion FROM scored)
"""


# null and NaN fail it too
VALID = "coalesce(p >= 0 AND p <= 1, FALSE)"


def rank_views(source: str = "long_scores", key: str = "experiment") -> str:
    """Plain windows over the distinct scores of each group."""
    return f""",
ties AS (
  SELECT {key} AS grp, p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos,
    sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg
  FROM {source} WHERE {VALID} GROUP BY {key}, p),
ranked AS (
  SELECT grp, p, pos, neg, sum(pos) OVER (PARTITION BY grp) AS tot_pos, sum(neg) OVER (PARTITION BY grp) AS tot_neg,
    sum(pos) OVER (PARTITION BY grp ORDER BY p DESC) AS tp,
    sum(neg) OVER (PARTITION BY grp ORDER BY p DESC) AS fp,
    sum(neg) OVER (PARTITION BY grp ORDER BY p) - neg AS neg_below
  FROM ties)
"""


def bundle_views(source: str = "long_scores", key: str = "experiment", threshold: float = 0.9) -> str:
    """The metric bundle per group."""
    return rank_views(source, key) + f""",
areas AS (
  SELECT grp,
    sum(CAST(pos AS DOUBLE) / nullif(tot_pos, 0) * (neg_below + neg / CAST(2 AS DOUBLE)) / nullif(tot_neg, 0)) AS roc_auc,
    sum(CAST(pos AS DOUBLE) / nullif(tot_pos, 0) * CAST(tp AS DOUBLE) / nullif(tp + fp, 0)) AS pr_auc
  FROM ranked GROUP BY grp),
counts AS (
  SELECT {key} AS grp, count(*) AS test_samples,
    sum(CASE WHEN {VALID} THEN 0 ELSE 1 END) AS invalid_scores,
    sum(CASE WHEN y = 0 AND {VALID} AND p < {threshold} THEN 1 ELSE 0 END) AS tn,
    sum(CASE WHEN y = 0 AND {VALID} AND p >= {threshold} THEN 1 ELSE 0 END) AS fp,
    sum(CASE WHEN y = 1 AND {VALID} AND p < {threshold} THEN 1 ELSE 0 END) AS fn,
    sum(CASE WHEN y = 1 AND {VALID} AND p >= {threshold} THEN 1 ELSE 0 END) AS tp
  FROM {source} GROUP BY {key}),
bundle AS (
  SELECT c.grp, test_samples, invalid_scores, tn, fp, fn, tp,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS "precision",
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
    coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1_score,
    roc_auc, pr_auc
  FROM counts c LEFT JOIN areas a ON a.grp IS NOT DISTINCT FROM c.grp)
"""
