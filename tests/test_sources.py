import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from riskspark.errors import DriftDataError
from riskspark.operators import features as X
from riskspark.session import ensure_checkpoint_dir, shared_folder
from riskspark.sources import readers as R, request_log as Q, sinks as W, testdata as D


def test_csv_with_declared_schema_keeps_bad_lines(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,isFraud,isFlaggedFraud\n"
                    "1,PAYMENT,5.0,C1,1,1,M1,0,0,0,0\n1,PAYMENT,abc,C1,1,1,M1,0,0,0,0\n")
    table = R.read_csv(spark, str(path), keep_corrupt=True).cache()
    assert table.where(F.col(R.CORRUPT).isNotNull()).count() == 1
    assert rows(R.read_csv(spark, str(path)).orderBy(F.asc_nulls_last("amount")), "amount") == [(5.0,), (None,)]


def test_format_by_suffix(spark, raw, tmp_path):
    W.write_table(raw, str(tmp_path / "a.parquet"))
    assert R.read_table(spark, str(tmp_path / "a.parquet")).count() == 2
    raw.write.json(str(tmp_path / "a.json"))
    with pytest.raises(DriftDataError, match="unsupported"):
        R.read_table(spark, str(tmp_path / "a.json"))
    with pytest.raises(FileNotFoundError):
        R.read_table(spark, str(tmp_path / "b.parquet"))


def test_drift_table_reads_only_the_features(spark, raw, tmp_path):
    path = W.write_table(X.add_features(raw), str(tmp_path / "f.parquet"))
    table = R.load_drift_table(spark, path)
    assert table.columns[-1] == "isFraud" and "nameOrig" not in table.columns
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "nameOrig" not in plan
    assert R.load_drift_table(spark, path, sample_size=1).count() == 1


def test_sample_is_exact_and_layout_free(spark, sf):
    t = D.transactions(spark, sf)
    one = R.sample_rows(t, "txn_id", 123)
    assert one.count() == 123
    assert sorted(rows(one, "txn_id")) == sorted(rows(R.sample_rows(t.repartition(5), "txn_id", 123), "txn_id"))
    assert R.sample_rows(t, "txn_id", 10**9).count() == t.count()


def test_partitioned_table(spark, raw, tmp_path):
    path = W.write_table(raw, str(tmp_path / "p"), ["type"])
    plan = spark.read.parquet(path).where("type = 'PAYMENT'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in plan


def test_json_reports(spark, tmp_path):
    report = spark.createDataFrame([("a", None, 1.5)], "check string, item string, value double")
    assert json.loads(W.as_json(report).first().value) == {"check": "a", "item": None, "value": 1.5}
    path = W.write_report(report, str(tmp_path / "r"))
    assert rows(spark.read.schema(report.schema).json(path)) == [("a", None, 1.5)]


def test_decision_log_only_grows(spark, tmp_path):
    path = str(tmp_path / "log")
    one = spark.createDataFrame([("REJECT",)], "decision string")
    W.append_decisions(one, path)
    W.append_decisions(one, path)
    log = W.read_decisions(spark, path)
    assert log.count() == 2 and "recorded_at" in log.columns


def test_a_repeated_job_logs_its_decision_once(spark, tmp_path):
    path = str(tmp_path / "log")
    one = spark.createDataFrame([("a", 1.0, "REJECT"), ("b", None, "PROMOTE")], "model string, delta double, decision string")
    for run in ("r1", "r1", "r2", None, None):
        W.append_decisions(one, path, run, ["model"])
    assert sorted(rows(W.read_decisions(spark, path).groupBy("model").count())) == [("a", 4), ("b", 4)]
    # two tries that did not see each other: the earlier record stands, however metrics differ
    again = spark.read.parquet(path).orderBy("decision_id").limit(1)
    again.withColumns({"delta": F.lit(9.0), "recorded_at": F.current_timestamp()}).write.mode("append").parquet(path)
    log = W.read_decisions(spark, path)
    assert log.count() == 8 and log.where("delta = 9").count() == 0
    # a log begun before there were ids
    old = str(tmp_path / "old")
    one.withColumn("recorded_at", F.current_timestamp()).write.parquet(old)
    assert W.read_decisions(spark, old).count() == 2
    W.append_decisions(one, old, "r1", ["model"])
    assert W.read_decisions(spark, old).count() == 4


def test_request_log_round_trip(spark, sf, tmp_path):
    path = str(tmp_path / "log")
    log = D.requests(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    Q.write_request_log(log, path)
    assert Q.read_request_log(spark, path).count() == log.count()
    assert Q.stream_request_log(spark, path, files_per_trigger=1).isStreaming


def test_adapters_are_projections(spark, sf):
    for table in (D.transactions(spark, sf), D.dirty(spark, sf), D.scored(spark, sf), D.requests(spark, sf),
                  D.lineitem_transactions(spark, sf)):
        assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
    plan = D.scored(spark, sf).select("y")._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in plan and "props" not in plan


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    ensure_checkpoint_dir(spark)
    assert shared_folder(spark) in spark.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("n", [1, 7, 60, 61, 139, 140, 500])
def test_keyless_sample_takes_as_many_equal_rows_as_it_needs(spark, n):
    # 100 rows are alike, 40 are not
    table = spark.range(140).selectExpr("CASE WHEN id < 100 THEN 'same' ELSE concat('k', id) END AS a", "CAST(NULL AS INT) AS b")
    one, again = R.sample_contents(table, n), R.sample_contents(table.repartition(9), n)
    assert one.count() == min(n, 140) and one.columns == ["a", "b"]
    assert sorted(rows(one), key=str) == sorted(rows(again), key=str)
    assert one.exceptAll(table).isEmpty()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan.split("Union")[0]
    assert R.sample_contents(table.limit(0), n).count() == 0
