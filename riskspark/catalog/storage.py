"""Writers and readers, as round trips: what is read back must be what the tables hold."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskspark.catalog.drift import QUERIES as DRIFT, pair
from riskspark.catalog.features import BASE
from riskspark.catalog.modelling import _model
from riskspark.catalog.shape import rounded
from riskspark.catalog.splitting import _split_views
from riskspark.catalog.tables_sql import TABLES
from riskspark.config import ModelConfig
from riskspark.errors import MissingTargetError
from riskspark.operators import encode as C, explore as E, features as X, split as P, train as L
from riskspark.plans import jobs as J
from riskspark.session import scratch_path
from riskspark.sources import request_log as Q, sinks as W, testdata as D

T = D.transactions


def parquet_round_trip(s, sf):
    """Written twice over, partitioned by type: the second write replaces the first."""
    path = scratch_path(s, "table")
    kept = X.preprocess(T(s, sf).drop("ts"))
    W.write_table(kept.where("isFraud = 1"), path, ["type"])
    return rounded(s.read.parquet(W.write_table(kept, path, ["type"])))


def json_report_round_trip(s, sf):
    report = rounded(E.fraud_rate_by(T(s, sf)))
    return s.read.schema(report.schema).json(W.write_report(report, scratch_path(s, "report")))


def decision_log(s, sf):
    """Two runs, one of them repeated: a decision is logged once a run."""
    decided = T(s, sf).groupBy("type").agg(F.sum("isFraud").alias("fraud")).withColumn(
        "decision", F.when(F.col("fraud") > 0, "REJECT").otherwise("PROMOTE"))
    path = scratch_path(s, "decisions")
    for run in ("first", "second", "first"):
        W.append_decisions(decided.withColumn("run", F.lit(run)), path, run, ["type"])
    return W.read_decisions(s, path).select("run", "type", "fraud", "decision", F.col("recorded_at").isNotNull().alias("dated"))


def request_log_round_trip(s, sf):
    requests = D.requests(s, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    log = Q.read_request_log(s, Q.write_request_log(requests, scratch_path(s, "requests")))
    return log.select("request_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "method", "path", "status",
                      F.round("latency_ms", 6).alias("latency_ms"), F.round("probability", 6).alias("probability"))


def target_guard(s, sf):
    """Rows that pass with the target, and whether the table is refused without it."""
    t = D.raw_transactions(s, sf)
    try:
        X.preprocess(t.drop("isFraud"))
        refused = False
    except MissingTargetError:
        refused = True
    return X.require_target(t).agg(F.count("*").alias("rows")).withColumn("refused_without", F.lit(refused))


def features_and_target(s, sf):
    t = X.clean(T(s, sf).drop("ts"))
    features, target = X.features_and_target(t)
    return rounded(t.select(*features, F.col(target).alias("target")))


def column_kinds(s, sf):
    """Each column that the encoders would take, its kind, and its values that are not null."""
    t = D.dirty(s, sf).drop("amount_cents_text")
    kinds = {c: "numeric" for c in C.numeric_columns(t)} | {c: "categorical" for c in C.categorical_columns(t)}
    counted = t.agg(*[F.count(c).alias(c) for c in kinds])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind"), F.col(c).alias("present")) for c, k in kinds.items()])))


NUMBERS = ("txn_id", "step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud")
NAMES = ("type", "nameOrig", "nameDest")


def model_round_trip(s, sf):
    """Scores of the model and of the model saved and loaded again, over the test rows."""
    train, test = P.train_test(T(s, sf), "txn_id")
    model = _model(s, sf, train)
    again = L.load_model(L.save_model(model, scratch_path(s, "model-again")))
    a, b = (L.score(test, m, keep=["txn_id"]).select("txn_id", F.col(L.PROBABILITY).alias(n)) for m, n in ((model, "a"), (again, "b")))
    return a.join(b, "txn_id").select("txn_id", (F.col("a") == F.col("b")).alias("same"))


def same_holdout(s, sf):
    """Two models over one holdout: every row once for each, with the same label."""
    train, test = P.train_test(T(s, sf), "txn_id")
    model = _model(s, sf, train)
    scored = J.same_holdout(test, {"candidate": model, "champion": model}, "txn_id", "isFraud", ModelConfig().threshold,
                            scratch_path(s, "holdout"))
    return scored.select("experiment", "txn_id", "y")


def drift_run(s, sf):
    """Both tables written, loaded, checked and compared; the summary read back from its JSON."""
    reference, current = (W.write_table(t, scratch_path(s, n) + ".parquet") for t, n in zip(pair(s, sf), ("reference", "current")))
    return rounded(J.drift_job(s, reference, current, scratch_path(s, "drift"))).select(
        "drifted_features", "drifted", "drift_share", "dataset_drift_detected", "reference_rows", "current_rows")


def onehot_vectors(s, sf):
    """Account names as a sparse vector: one row per entry, with the level it stands for."""
    t = T(s, sf).select("txn_id", "nameDest")
    slots, _ = C.level_table(t, "nameDest")
    hot = C.one_hot_vectors(t, "nameDest").select("txn_id", F.nullif(F.array_position(vector_to_array("onehot"), 1.0), F.lit(0)).alias("at"))
    return hot.join(slots, F.col("at") == F.col("slot") + 1, "left").select("txn_id", "level", (F.col("at") - 1).alias("slot").cast("int"))


QUERIES = {
    "parquet_round_trip": (parquet_round_trip, TABLES + f"SELECT txn_id, {BASE} FROM transactions"),
    "json_report_round_trip": (
        json_report_round_trip,
        TABLES + """SELECT type, count(*) AS transactions, CAST(sum(isFraud) AS BIGINT) AS fraud, round(avg(isFraud), 6) AS fraud_rate
        FROM transactions GROUP BY type""",
    ),
    "decision_log": (
        decision_log,
        TABLES + """SELECT run, type, CAST(sum(isFraud) AS BIGINT) AS fraud, CASE WHEN sum(isFraud) > 0 THEN 'REJECT' ELSE 'PROMOTE' END AS decision,
        true AS dated FROM transactions CROSS JOIN (VALUES ('first'), ('second')) r(run) GROUP BY run, type""",
    ),
    "request_log_round_trip": (
        request_log_round_trip,
        TABLES + """SELECT request_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, method, path, status, round(latency_ms, 6) AS latency_ms,
        round(probability, 6) AS probability FROM requests""",
    ),
    "target_guard": (target_guard, TABLES + "SELECT count(*) AS rows, true AS refused_without FROM transactions"),
    "features_and_target": (
        features_and_target,
        TABLES + "SELECT txn_id, " + BASE.replace(", isFraud", "") + """, round(balance_diff_orig, 6) + 0 AS balance_diff_orig,
        round(balance_diff_dest, 6) + 0 AS balance_diff_dest, round(amount_to_balance_ratio, 6) AS amount_to_balance_ratio,
        isFraud AS target FROM featured""",
    ),
    "column_kinds": (
        column_kinds,
        TABLES + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{k}' AS kind, count({c}) AS present FROM dirty"
            for k, names in (("numeric", NUMBERS), ("categorical", NAMES)) for c in names),
    ),
    "onehot_vectors": (
        onehot_vectors,
        TABLES + """, lv AS (SELECT nameDest AS level, row_number() OVER (ORDER BY nameDest) - 2 AS slot FROM (SELECT DISTINCT nameDest FROM transactions))
        SELECT txn_id, CASE WHEN slot >= 0 THEN level END AS level, CASE WHEN slot >= 0 THEN CAST(slot AS INT) END AS slot
        FROM transactions JOIN lv ON lv.level = nameDest""",
    ),
    "model_round_trip": (
        model_round_trip, TABLES + _split_views("isFraud") + "SELECT txn_id, true AS same FROM split WHERE split = 'test'"),
    "same_holdout": (
        same_holdout,
        TABLES + _split_views("isFraud") + """SELECT experiment, txn_id, isFraud AS y FROM split
        CROSS JOIN (VALUES ('candidate'), ('champion')) e(experiment) WHERE split = 'test'""",
    ),
    "drift_run": (
        drift_run,
        "SELECT drifted_features, drifted, drift_share, dataset_drift_detected, CAST(reference_rows AS BIGINT) AS reference_rows, "
        "CAST(current_rows AS BIGINT) AS current_rows FROM (" + DRIFT["drift_summary"][1] + ")",
    ),
}
