"""Exploratory aggregates over the transactions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from riskspark.catalog.shape import rounded
from riskspark.catalog.tables_sql import TABLES
from riskspark.config import CORRELATED_COLUMNS
from riskspark.operators import explore as E, features as X, validate as V
from riskspark.sources import readers as R, testdata as D

T = D.transactions
BOX = """,
x AS (SELECT isFraud, {value} AS x FROM transactions),
q AS (SELECT isFraud, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM x GROUP BY isFraud),
f AS (SELECT x.isFraud, x, q1, median, q3, x BETWEEN q1 - (q3 - q1) * 1.5::DOUBLE AND q3 + (q3 - q1) * 1.5::DOUBLE AS inside
  FROM x JOIN q ON q.isFraud = x.isFraud)
SELECT isFraud, count(*) AS rows, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
  round(min(x) FILTER (WHERE inside), 6) AS whisker_low, round(max(x) FILTER (WHERE inside), 6) AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS outliers
FROM f GROUP BY isFraud"""
CORRELATED_WITH_DIFFS = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
                         "balance_diff_orig", "balance_diff_dest", "isFraud")


def _top(column: str, where: str = "") -> str:
    return TABLES + f"SELECT {column}, count(*) AS rows FROM transactions {where} GROUP BY {column} ORDER BY rows DESC, {column} LIMIT 10"


def _correlations(columns, table):
    return TABLES + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(CASE WHEN stddev_pop({a}) = 0 OR stddev_pop({b}) = 0 THEN NULL ELSE corr({a}, {b}) END, 6) AS corr FROM {table}"
        for a, b in product(columns, columns)
    )


QUERIES = {
    "class_distribution": (
        lambda s, sf: rounded(V.class_distribution(D.dirty(s, sf))),
        TABLES + """SELECT count(*) AS rows, count(*) FILTER (WHERE isFraud = 0) AS non_fraud, count(*) FILTER (WHERE isFraud = 1) AS fraud,
        round(CAST(count(*) FILTER (WHERE isFraud = 1) AS DOUBLE) * 100 / count(*), 6) AS fraud_percent,
        round(CAST(count(*) FILTER (WHERE isFraud = 0) AS DOUBLE) / count(*) FILTER (WHERE isFraud = 1), 6) AS imbalance_ratio FROM dirty""",
    ),
    "type_counts": (
        lambda s, sf: E.value_counts(T(s, sf), "type"),
        TABLES + "SELECT type, count(*) AS rows FROM transactions GROUP BY type",
    ),
    "type_class_pivot": (
        lambda s, sf: E.class_pivot(T(s, sf)),
        TABLES + """SELECT type, count(*) FILTER (WHERE isFraud = 0) AS non_fraud, count(*) FILTER (WHERE isFraud = 1) AS fraud
        FROM transactions GROUP BY type""",
    ),
    "type_class_crosstab": (
        lambda s, sf: E.crosstab_with_margins(T(s, sf)),
        TABLES + """SELECT CASE WHEN grouping(type) = 1 THEN 'All' ELSE type END AS type, count(*) FILTER (WHERE isFraud = 0) AS class_0,
        count(*) FILTER (WHERE isFraud = 1) AS class_1, count(isFraud) AS all_classes FROM transactions GROUP BY ROLLUP (type)""",
    ),
    "fraud_rate_by_type": (
        lambda s, sf: rounded(E.fraud_rate_by(T(s, sf))),
        TABLES + """SELECT type, count(*) AS transactions, CAST(sum(isFraud) AS BIGINT) AS fraud, round(avg(isFraud), 6) AS fraud_rate
        FROM transactions GROUP BY type""",
    ),
    "amount_describe": (
        lambda s, sf: rounded(E.describe(T(s, sf), "amount").withColumn("whole", F.col("value").cast("bigint"))),
        TABLES + """, ds AS (SELECT count(amount) AS c, avg(amount) AS a, stddev_samp(amount) AS sd, min(amount) AS lo, max(amount) AS hi,
          quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.5) AS q2, quantile_cont(amount, 0.75) AS q3 FROM transactions),
        r AS (SELECT 'count' AS statistic, CAST(c AS DOUBLE) AS value FROM ds UNION ALL SELECT 'mean', a FROM ds UNION ALL SELECT 'std', sd FROM ds
          UNION ALL SELECT 'min', lo FROM ds UNION ALL SELECT 'max', hi FROM ds UNION ALL SELECT '25%', q1 FROM ds
          UNION ALL SELECT '50%', q2 FROM ds UNION ALL SELECT '75%', q3 FROM ds)
        SELECT statistic, round(value, 6) AS value, CAST(trunc(value) AS BIGINT) AS whole FROM r""",
    ),
    "top_senders": (lambda s, sf: E.top_values(T(s, sf), "nameOrig"), _top("nameOrig")),
    "top_receivers": (lambda s, sf: E.top_values(T(s, sf), "nameDest"), _top("nameDest")),
    "top_fraud_senders": (
        lambda s, sf: E.top_values(T(s, sf).where("isFraud = 1"), "nameOrig"), _top("nameOrig", "WHERE isFraud = 1"),
    ),
    "correlation_long": (
        lambda s, sf: rounded(E.correlation_pairs(T(s, sf))), _correlations(CORRELATED_COLUMNS, "transactions"),
    ),
    "correlation_with_diffs": (
        lambda s, sf: rounded(E.correlation_pairs(X.add_features(T(s, sf)), CORRELATED_WITH_DIFFS)),
        _correlations(CORRELATED_WITH_DIFFS, "featured"),
    ),
    "amount_histogram": (
        lambda s, sf: rounded(E.log_histogram(T(s, sf), F.col("amount") + 1)),
        TABLES + """, x AS (SELECT log10(amount + 1) AS x FROM transactions), m AS (SELECT min(x) AS lo, (max(x) - min(x)) / 50 AS w FROM x),
        bins AS (SELECT least(CAST(floor((x - lo) / w) AS INT), 49) AS bin, count(*) AS n FROM x, m GROUP BY 1)
        SELECT CAST(i AS INT) AS bin, round(lo + i * w, 6) AS low, round(lo + (i + 1) * w, 6) AS high, coalesce(n, 0) AS rows
        FROM range(50) r(i) CROSS JOIN m LEFT JOIN bins ON bins.bin = i""",
    ),
    "amount_box_by_class": (
        lambda s, sf: rounded(E.box_summary(T(s, sf), E.log_amount())),
        TABLES + BOX.format(value="ln(1 + amount)"),
    ),
    "balance_box_by_class": (
        lambda s, sf: rounded(E.box_summary(T(s, sf), E.log_balance_change())),
        TABLES + BOX.format(value="ln(1 + abs(oldbalanceOrg - newbalanceOrig))"),
    ),
    "amount_by_class": (
        lambda s, sf: rounded(E.stats_by_class(T(s, sf))),
        TABLES + """SELECT isFraud, count(amount) AS rows, round(avg(amount), 6) AS mean, round(max(amount), 6) AS max,
        round(quantile_cont(amount, 0.5), 6) AS median FROM transactions GROUP BY isFraud""",
    ),
    "flag_rule_efficiency": (
        lambda s, sf: rounded(E.flag_rule_efficiency(T(s, sf))),
        TABLES + """SELECT sum(isFlaggedFraud)::BIGINT AS flagged, sum(isFraud)::BIGINT AS fraud, sum(isFlaggedFraud * isFraud)::BIGINT AS caught,
        sum((1 - isFlaggedFraud) * isFraud)::BIGINT AS missed,
        round(CAST(sum((1 - isFlaggedFraud) * isFraud) AS DOUBLE) / sum(isFraud), 6) AS miss_rate FROM transactions""",
    ),
    "cardinality": (
        lambda s, sf: E.cardinality(T(s, sf), ["type", "nameOrig", "nameDest", "step"]),
        TABLES + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values FROM transactions"""
            for c in ("type", "nameOrig", "nameDest", "step")),
    ),
    "cardinality_sketch": (
        lambda s, sf: E.approximate_cardinality(T(s, sf), ["type", "nameOrig", "nameDest", "step"]), None,
    ),
    "amount_quantile_sketch": (
        lambda s, sf: E.approximate_quantiles(T(s, sf), "amount", [0.25, 0.5, 0.75]), None,
    ),
    "type_filter_effect": (
        lambda s, sf: rounded(E.type_filter_effect(T(s, sf))),
        TABLES + """, k AS (SELECT *, type IN ('CASH_OUT', 'TRANSFER') AS kept FROM transactions)
        SELECT count(*) AS rows, count(*) FILTER (WHERE kept) AS rows_kept, count(*) FILTER (WHERE kept AND isFraud = 1) AS fraud_kept,
        count(*) FILTER (WHERE isFraud = 1) AS fraud, count(*) FILTER (WHERE NOT kept AND isFraud = 0) AS non_fraud_dropped,
        count(*) FILTER (WHERE isFraud = 0) AS non_fraud,
        round(CAST(count(*) FILTER (WHERE NOT kept AND isFraud = 0) AS DOUBLE) / count(*) FILTER (WHERE isFraud = 0), 6) AS non_fraud_dropped_share FROM k""",
    ),
    "drained_accounts": (
        lambda s, sf: E.drained_counts(T(s, sf)),
        TABLES + """SELECT count(*) AS drained, count(*) FILTER (WHERE isFraud = 1) AS drained_fraud FROM transactions
        WHERE oldbalanceOrg > 0 AND newbalanceOrig = 0 AND type IN ('TRANSFER', 'CASH_OUT')""",
    ),
    "zero_dest": (
        lambda s, sf: E.unchanged_recipient(T(s, sf)),
        TABLES + """SELECT isFraud, count(*) AS rows, count(*) FILTER (WHERE oldbalanceDest = 0 AND newbalanceDest = 0) AS zero_recipient,
        count(*) FILTER (WHERE oldbalanceDest = newbalanceDest) AS unchanged_recipient FROM transactions WHERE type = 'CASH_OUT' GROUP BY isFraud""",
    ),
    "fixed_sample": (
        lambda s, sf: E.fixed_sample(T(s, sf), "txn_id", 777).select("txn_id"),
        TABLES + "SELECT txn_id FROM transactions ORDER BY md5(concat(CAST(txn_id AS VARCHAR), ':42')), txn_id LIMIT 777",
    ),
    "drift_sample": (
        lambda s, sf: rounded(R.drift_columns(R.sample_rows(X.add_features(T(s, sf)), "txn_id", 500))),
        TABLES + """SELECT type, isFraud, """ + ", ".join(
            f"round({c}, 6) + 0 AS {c}" for c in ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
                                           "balance_diff_orig", "balance_diff_dest", "amount_to_balance_ratio"))
        + " FROM featured ORDER BY md5(concat(CAST(txn_id AS VARCHAR), ':42')), txn_id LIMIT 500",
    ),
}
