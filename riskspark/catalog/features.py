"""Cleaning and features over the transactions."""

from __future__ import annotations

from riskspark.catalog.shape import rounded
from riskspark.catalog.tables_sql import TABLES
from riskspark.config import FeatureConfig
from riskspark.operators import encode as C, features as X
from riskspark.sources import testdata as D

BASE = "type, round(amount, 6) AS amount, round(oldbalanceOrg, 6) AS oldbalanceOrg, round(newbalanceOrig, 6) AS newbalanceOrig, " \
       "round(oldbalanceDest, 6) AS oldbalanceDest, round(newbalanceDest, 6) AS newbalanceDest, isFraud"
DERIVED = "round(balance_diff_orig, 6) + 0 AS balance_diff_orig, round(balance_diff_dest, 6) + 0 AS balance_diff_dest, " \
          "round(amount_to_balance_ratio, 6) AS amount_to_balance_ratio"
NUMERIC = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
           "balance_diff_orig", "balance_diff_dest", "amount_to_balance_ratio")

STANDARD_SQL = TABLES + ", m AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC
) + " FROM featured) SELECT txn_id, " + ", ".join(
    f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) + 0 AS {c}" for c in NUMERIC
) + " FROM featured, m"


def keyed(spark, sf):
    return D.transactions(spark, sf).drop("ts")


QUERIES = {
    "clean_transactions": (
        lambda s, sf: rounded(X.clean(keyed(s, sf))),
        TABLES + f"SELECT txn_id, {BASE}, {DERIVED} FROM featured",
    ),
    "clean_transactions_dirty": (
        lambda s, sf: rounded(X.clean(D.dirty(s, sf)).drop("amount_cents_text")),
        TABLES + f"""SELECT txn_id, {BASE}, round(oldbalanceOrg - newbalanceOrig, 6) + 0 AS balance_diff_orig,
        round(newbalanceDest - oldbalanceDest, 6) + 0 AS balance_diff_dest,
        round(CASE WHEN oldbalanceOrg = -1 THEN NULL ELSE amount / (oldbalanceOrg + 1) END, 6) AS amount_to_balance_ratio FROM dirty""",
    ),
    "preprocess": (
        lambda s, sf: rounded(X.preprocess(keyed(s, sf))), TABLES + f"SELECT txn_id, {BASE} FROM transactions",
    ),
    "features": (
        lambda s, sf: rounded(X.add_features(keyed(s, sf)).select(
            "txn_id", "balance_diff_orig", "balance_diff_dest", "amount_to_balance_ratio")),
        TABLES + f"SELECT txn_id, {DERIVED} FROM featured",
    ),
    "features_toggled": (
        lambda s, sf: rounded(X.clean(keyed(s, sf), features=FeatureConfig(balance_diffs=False))),
        TABLES + f"SELECT txn_id, {BASE}, round(amount_to_balance_ratio, 6) AS amount_to_balance_ratio FROM featured",
    ),
    "stage_report": (
        lambda s, sf: X.stage_report(raw := D.raw_transactions(s, sf), X.clean(raw), "clean"),
        TABLES + """SELECT 'clean' AS stage, count(*) AS input_rows, CAST(11 AS INT) AS input_columns, count(*) AS output_rows,
        CAST(10 AS INT) AS output_columns, 'step,nameOrig,nameDest,isFlaggedFraud' AS features_removed,
        'balance_diff_orig,balance_diff_dest,amount_to_balance_ratio' AS features_created,
        'type,amount,oldbalanceOrg,newbalanceOrig,oldbalanceDest,newbalanceDest,isFraud,balance_diff_orig,balance_diff_dest,amount_to_balance_ratio' AS final_columns,
        'SUCCESS' AS status FROM transactions""",
    ),
    "onehot_type": (
        lambda s, sf: (lambda t: t.select("txn_id", *[
            c.alias(n) for n, c in C.one_hot("type", C.categories(t, "type")).items()]))(D.transactions(s, sf)),
        TABLES + "SELECT txn_id, " + ", ".join(
            f"CASE WHEN type = '{t}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS type_{t}"
            for t in ("CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")
        ) + " FROM transactions",
    ),
    "standardize": (
        lambda s, sf: rounded(C.standardize(X.add_features(D.transactions(s, sf))).select("txn_id", *NUMERIC)),
        STANDARD_SQL,
    ),
}
