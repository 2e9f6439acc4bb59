"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from riskspark.config import NUMERIC_FEATURES, ModelConfig  # noqa: E402
from riskspark.operators import (  # noqa: E402
    drift, explore, features, metrics, monitor, resample, selection, split, train, validate,
)
from riskspark.session import build_session, scratch_path  # noqa: E402
from riskspark.sources import testdata as D  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2


def workloads(spark: SparkSession):
    """name -> run; transactions come from the larger table (lineitem), the log from events."""
    transactions = D.lineitem_transactions(spark, SF_DIR)
    raw = transactions.drop("txn_id", "ts")
    scored = metrics.to_long(
        D.scored_from(transactions), {"candidate": "p_candidate", "champion": "p_champion"}
    )
    log = D.requests(spark, SF_DIR)

    def sink(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    # the same rows ten times under other ids and in many files: the scale of the published runs
    tenfold = scratch_path(spark, "tenfold")
    raw.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(10)))).withColumn(
        "nameOrig", F.concat("nameOrig", F.lit("-"), F.col("_copy"))).drop("_copy").repartition(32).write.parquet(tenfold)
    large = spark.read.parquet(tenfold)
    labelled = transactions.select("txn_id", "isFraud", F.array("amount", "oldbalanceOrg", "newbalanceDest").alias("features"))

    def fit_and_score():
        fit, test = split.train_test(transactions, "txn_id")
        sink(train.score(test, train.fit(fit, "txn_id", model=ModelConfig(trees=5)), keep=["txn_id"]))

    def drift_pair():
        return D.drift_pair(features.add_features(transactions))

    return {
        "feature_stage": lambda: sink(features.clean(raw)),
        "feature_stage_write_10x": lambda: features.clean(large).write.mode("overwrite").parquet(f"{tenfold}-clean"),
        "validate_10x": lambda: validate.validate(large).collect(),
        "smote": lambda: sink(resample.smote(labelled, "txn_id", "features")),
        "fit_5_trees_and_score": fit_and_score,
        "validate": lambda: validate.validate(raw).collect(),
        "duplicates": lambda: validate.duplicate_count(raw).collect(),
        "fraud_rate_by_type": lambda: explore.fraud_rate_by(transactions).collect(),
        "top_senders": lambda: explore.top_values(transactions, "nameOrig").collect(),
        "amount_describe": lambda: explore.describe(transactions, "amount").collect(),
        "correlation": lambda: explore.correlation_pairs(transactions).collect(),
        "stratified_split": lambda: sink(split.assign_split(transactions, "txn_id")),
        "metric_bundle": lambda: metrics.metric_bundle(scored, 0.9).collect(),
        "threshold_grid": lambda: selection.threshold_grid(scored, by=["experiment"]).collect(),
        "promotion_gate": lambda: selection.promotion_gate(
            selection.metric_deltas(metrics.metric_bundle(scored, 0.9))).collect(),
        "drift_numeric": lambda: drift.numeric_distances(*drift_pair(), NUMERIC_FEATURES).collect(),
        "drift_categorical": lambda: drift.categorical_distances(*drift_pair(), ["type"]).collect(),
        "request_totals": lambda: monitor.request_totals(log).collect(),
        "request_rate_5m": lambda: sink(monitor.request_rate(log)),
        "latency_p95_5m": lambda: sink(monitor.latency_quantile(log)),
    }


def main() -> None:
    spark = build_session("riskspark-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, run in workloads(spark).items():
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "rows": {"transactions": spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count(),
                 "log": spark.read.parquet(f"{SF_DIR}/events.parquet").count()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
