"""Table validation and admission over the dirty table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog.shape import rounded
from riskspark.catalog.tables_sql import TABLES, VIOLATIONS
from riskspark.operators import admission as A, features as X, validate as V
from riskspark.sources import testdata as D

RAW = ("step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
       "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud")
RAW_LIST = ", ".join(RAW)
MINIMUMS = {"amount": 0, "step": 1, "oldbalanceOrg": 0, "newbalanceOrig": 0, "oldbalanceDest": 0,
            "newbalanceDest": 0}


def raw_dirty(spark, sf):
    return D.dirty(spark, sf).select(*RAW)


def _union(parts):
    return " UNION ALL ".join(parts)


NULLS_SQL = TABLES + _union(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls,
    round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS null_percent,
    CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 'WARNING' ELSE 'PASSED' END AS status FROM dirty"""
    for c in RAW
)
SANITY_SQL = TABLES + _union(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < {low}) AS violations,
    CASE WHEN count(*) FILTER (WHERE {c} < {low}) > 0 THEN 'FAILED' ELSE 'PASSED' END AS status FROM dirty"""
    for c, low in MINIMUMS.items()
)
COPIES = f"(SELECT count(*) AS n FROM (SELECT DISTINCT {RAW_LIST} FROM dirty)) "

REPORT_SQL = TABLES + f""",
c AS (SELECT
  count(*) AS rows,
  {", ".join(f"count(*) FILTER (WHERE {x} IS NULL) AS null_{x}" for x in RAW)},
  {", ".join(f"count(*) FILTER (WHERE {x} < {low}) AS low_{x}" for x, low in MINIMUMS.items())},
  count(*) FILTER (WHERE isFraud IS NOT NULL AND isFraud NOT IN (0, 1)) AS bad_target,
  count(*) FILTER (WHERE isFraud = 1) AS fraud, count(*) FILTER (WHERE isFraud = 0) AS non_fraud
  FROM dirty),
n AS (SELECT *, {" + ".join(f"null_{x}" for x in RAW)} AS nulls, {" + ".join(f"low_{x}" for x in MINIMUMS)} AS lows,
  rows - (SELECT n FROM {COPIES}) AS copies FROM c),
checks AS (
  SELECT 'schema' AS "check", NULL AS item, 'PASSED' AS status, 0 AS value FROM n
  UNION ALL SELECT 'data_types', NULL, 'PASSED', 0 FROM n
  {" ".join(f"UNION ALL SELECT 'data_types', '{x}', 'PASSED', NULL FROM n" for x in RAW)}
  UNION ALL SELECT 'dataset_size', 'rows', CASE WHEN rows = 0 THEN 'FAILED' ELSE 'PASSED' END, rows FROM n
  UNION ALL SELECT 'dataset_size', 'columns', 'PASSED', {len(RAW)} FROM n
  UNION ALL SELECT 'null_values', NULL, CASE WHEN nulls > 0 THEN 'WARNING' ELSE 'PASSED' END, nulls FROM n
  {" ".join(f"UNION ALL SELECT 'null_values', '{x}', CASE WHEN null_{x} > 0 THEN 'WARNING' ELSE 'PASSED' END, null_{x} FROM n" for x in RAW)}
  UNION ALL SELECT 'numerical_sanity', NULL, CASE WHEN lows > 0 THEN 'FAILED' ELSE 'PASSED' END, lows FROM n
  {" ".join(f"UNION ALL SELECT 'numerical_sanity', '{x}', CASE WHEN low_{x} > 0 THEN 'FAILED' ELSE 'PASSED' END, low_{x} FROM n" for x in MINIMUMS)}
  UNION ALL SELECT 'target_column', 'isFraud', CASE WHEN bad_target > 0 THEN 'FAILED' ELSE 'PASSED' END, bad_target FROM n
  UNION ALL SELECT 'target_column', 'fraud', 'INFO', fraud FROM n
  UNION ALL SELECT 'target_column', 'non_fraud', 'INFO', non_fraud FROM n
  UNION ALL SELECT 'target_column', 'fraud_percent', 'INFO', CAST(fraud AS DOUBLE) * 100 / rows FROM n
  UNION ALL SELECT 'duplicates', NULL, CASE WHEN copies > 0 THEN 'WARNING' ELSE 'PASSED' END, copies FROM n
  UNION ALL SELECT 'duplicates', 'percent', 'INFO', CAST(copies AS DOUBLE) * 100 / rows FROM n)
SELECT "check", item, status, round(CAST(value AS DOUBLE), 6) AS value FROM checks
UNION ALL SELECT 'overall', NULL, CASE WHEN count(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'FAILED' ELSE 'PASSED' END,
  CAST(count(*) FILTER (WHERE status = 'FAILED') AS DOUBLE) FROM checks
"""

FEATURE_NAMES = ("type", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest",
                 "newbalanceDest", "balance_diff_orig", "balance_diff_dest", "amount_to_balance_ratio")


def _bad(c: str) -> str:
    return f"{c} IS NULL" if c == "type" else f"{c} IS NULL OR isnan({c}) OR isinf({c})"


DRIFT_INPUT_SQL = TABLES + """,
df AS (SELECT *, oldbalanceOrg - newbalanceOrig AS balance_diff_orig, newbalanceDest - oldbalanceDest AS balance_diff_dest,
  CASE WHEN oldbalanceOrg + 1 = 0 THEN NULL ELSE amount / (oldbalanceOrg + CAST(1 AS DOUBLE)) END AS amount_to_balance_ratio FROM dirty)
""" + _union(
    f"SELECT count(*) AS rows, '{c}' AS feature, count(*) FILTER (WHERE {_bad(c)}) AS bad_values FROM df"
    for c in FEATURE_NAMES
)

QUERIES = {
    "val_size": (
        lambda s, sf: V.size_report(raw_dirty(s, sf)),
        TABLES + f"""SELECT count(*) AS rows, CAST({len(RAW)} AS BIGINT) AS columns,
        CASE WHEN count(*) = 0 THEN 'FAILED' ELSE 'PASSED' END AS status FROM dirty""",
    ),
    "val_nulls": (lambda s, sf: rounded(V.null_report(raw_dirty(s, sf))), NULLS_SQL),
    "val_duplicates": (
        lambda s, sf: rounded(V.duplicate_count(raw_dirty(s, sf))),
        TABLES + f"""SELECT rows, rows - n AS duplicates, round(CAST(rows - n AS DOUBLE) * 100 / rows, 6) AS duplicate_percent,
        CASE WHEN rows > n THEN 'WARNING' ELSE 'PASSED' END AS status
        FROM (SELECT count(*) AS rows FROM dirty), {COPIES}""",
    ),
    "val_target_domain": (
        lambda s, sf: V.target_domain(raw_dirty(s, sf)),
        TABLES + """SELECT isFraud AS value, count(*) AS rows, isFraud IN (0, 1) AS allowed
        FROM dirty WHERE isFraud IS NOT NULL GROUP BY isFraud""",
    ),
    "val_sanity": (lambda s, sf: V.sanity_report(raw_dirty(s, sf)), SANITY_SQL),
    "val_report": (
        lambda s, sf: rounded(V.validate(raw_dirty(s, sf)).select("check", "item", "status", "value")),
        REPORT_SQL,
    ),
    "val_report_clean": (
        lambda s, sf: V.validate(D.raw_transactions(s, sf)).where(
            "check IN ('overall', 'dataset_size', 'target_column')"
        ).select("check", "item", "status", F.round("value", 6).alias("value")),
        TABLES + """SELECT 'dataset_size' AS "check", 'rows' AS item, 'PASSED' AS status, CAST(count(*) AS DOUBLE) AS value FROM transactions
        UNION ALL SELECT 'dataset_size', 'columns', 'PASSED', 11
        UNION ALL SELECT 'target_column', 'isFraud', 'PASSED', 0
        UNION ALL SELECT 'target_column', 'fraud', 'INFO', sum(isFraud) FROM transactions
        UNION ALL SELECT 'target_column', 'non_fraud', 'INFO', sum(1 - isFraud) FROM transactions
        UNION ALL SELECT 'target_column', 'fraud_percent', 'INFO', round(CAST(sum(isFraud) AS DOUBLE) * 100 / count(*), 6) FROM transactions
        UNION ALL SELECT 'overall', NULL, 'PASSED', 0""",
    ),
    "admission_split": (
        lambda s, sf: (lambda valid, bad: valid.select("txn_id", F.lit(True).alias("valid"), F.lit(0).alias("n_violations"),
                                                       F.lit("").alias("categories"))
                       .unionByName(bad.select(
                           "txn_id", F.lit(False).alias("valid"), F.size("violations").alias("n_violations"),
                           F.array_join(F.array_sort(F.transform("violations", lambda v: v["category"])), ",").alias("categories"),
                       )))(*A.admit(D.score_requests(s, sf))),
        TABLES + VIOLATIONS + """
        SELECT d.txn_id, v.txn_id IS NULL AS valid, CAST(coalesce(v.n, 0) AS INT) AS n_violations, coalesce(v.cats, '') AS categories
        FROM dirty d LEFT JOIN (
          SELECT txn_id, sum(n) AS n, string_agg(category, ',' ORDER BY category) AS cats
          FROM (SELECT DISTINCT txn_id, field, category, 1 AS n FROM violations) GROUP BY txn_id) v ON v.txn_id = d.txn_id""",
    ),
    "dq_violations": (
        lambda s, sf: A.violations_long(D.score_requests(s, sf), ["txn_id"]).select("txn_id", "field", "category"),
        TABLES + VIOLATIONS + "SELECT txn_id, field, category FROM violations",
    ),
    "dq_by_category": (
        lambda s, sf: A.count_by_category(A.violations_long(D.score_requests(s, sf))),
        TABLES + VIOLATIONS + "SELECT category, count(*) AS errors FROM violations GROUP BY category",
    ),
    "drift_input_check": (
        lambda s, sf: A.drift_input_counts(X.add_features(D.dirty(s, sf))), DRIFT_INPUT_SQL,
    ),
    "scored_sanity": (
        lambda s, sf: A.scored_sanity(D.scored(s, sf), "p_candidate"),
        TABLES + """SELECT count(*) AS rows, CAST(0 AS BIGINT) AS missing_decisions,
        count(*) FILTER (WHERE p_candidate IS NULL OR isnan(p_candidate) OR isinf(p_candidate)) AS non_finite,
        count(*) FILTER (WHERE p_candidate < 0 OR p_candidate > 1) AS outside_unit_interval,
        count(*) > 0 AND count(*) FILTER (WHERE p_candidate IS NULL OR isnan(p_candidate) OR p_candidate < 0 OR p_candidate > 1) = 0 AS valid
        FROM scored""",
    ),
    "lost_rows": (
        lambda s, sf: A.lost_rows(
            D.transactions(s, sf), D.requests(s, sf).where("probability IS NOT NULL").withColumnRenamed("request_id", "txn_id"),
            "txn_id",
        ),
        TABLES + """SELECT t.txn_id, CAST(1 AS BIGINT) AS expected, CAST(0 AS BIGINT) AS found FROM transactions t
        WHERE NOT EXISTS (SELECT 1 FROM requests r WHERE r.request_id = t.txn_id AND r.probability IS NOT NULL)""",
    ),
}
