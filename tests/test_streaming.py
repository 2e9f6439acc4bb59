import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from riskspark.config import DriftConfig
from riskspark.operators.admission import violations_long
from riskspark.operators import features as X, monitor as O
from riskspark.schema import REQUEST_LOG, SCORE_REQUEST_TEXT
from riskspark.sources import request_log as Q, testdata as D
from riskspark.streaming import drift as SD, labels as SL, monitor as SM, scoring as SS
from riskspark.streaming.run import write_stream

START = dt.datetime(2024, 1, 1)


def minutes(n):
    return START + dt.timedelta(minutes=n)


def request(i, minute, status=200, probability=None):
    return (i, minutes(minute), "POST", "/predict", status, 10.0, probability)


def write_files(spark, folder, batches, schema):
    """One file per batch, in order of modification time."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        for name in os.listdir(folder):
            path = os.path.join(folder, name)
            if name.startswith("part") and not os.path.exists(os.path.join(folder, f".seen-{name}")):
                os.utime(path, (1_700_000_000 + 60 * i,) * 2)
                open(os.path.join(folder, f".seen-{name}"), "w").close()


def run(spark, stream, tmp_path, name="out"):
    query = write_stream(stream, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"))
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(tmp_path / name)), query


def test_closed_windows_equal_batch_and_late_or_repeated_rows_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "log")
    batches = [
        [request(i, i, 500 if i % 3 == 0 else 200, 0.95 if i % 2 else 0.1) for i in range(20)],
        [request(5, 5, 200, 0.1), request(100, 40), request(101, 60)],
        [request(102, 1), request(103, 90)],  # 102 is far behind the watermark
    ]
    write_files(spark, folder, batches, REQUEST_LOG)
    log = Q.stream_request_log(spark, folder, files_per_trigger=1)
    found, query = run(spark, SM.request_series(log), tmp_path)

    kept = [r for b in batches for r in b if r[0] != 102]
    kept = list({r[0]: r for r in reversed(kept)}.values())
    batch = O.add_error_rate(O.request_rate(spark.createDataFrame(kept, REQUEST_LOG)))
    closed = batch.where(F.col("window_end") <= F.lit(minutes(80)))
    columns = ["window_start", "window_end", "requests", "errors", "requests_per_second", "error_rate"]
    assert sorted(rows(found, *columns)) == sorted(rows(closed, *columns))
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped >= 1


def test_fraud_probability_and_latency_series(spark, tmp_path):
    folder = str(tmp_path / "log")
    write_files(spark, folder, [[request(i, i % 10, 200, (i % 10) / 10) for i in range(40)] + [request(99, 60)]], REQUEST_LOG)
    log = spark.read.schema(REQUEST_LOG).parquet(folder).where("request_id < 99")
    stream = Q.stream_request_log(spark, folder)
    for name, series, batch in (
        ("fraud", SM.fraud_series(stream), O.fraud_rate(log)),
        ("probability", SM.probability_series(stream), O.probability_heatmap(log)),
        ("latency", SM.latency_series(stream), O.latency_quantile(log)),
    ):
        found, _ = run(spark, series, tmp_path, name)
        assert sorted(rows(found, *batch.columns)) == sorted(rows(batch)), name


def test_scoring_stream_splits_and_is_repeatable(spark, sf, tmp_path):
    class Fixed:
        """Stands in for a fitted pipeline."""
        numClasses = 2

        def transform(self, df):
            from pyspark.ml.functions import array_to_vector
            p = F.least(F.col("amount") / 1000, F.lit(1.0))
            return df.withColumn("probability", array_to_vector(F.array(1 - p, p)))

    folder = str(tmp_path / "in")
    batches = [[("TRANSFER", "950", "0", "0", "0", "0"), ("TRANSFER", "-5", "0", "0", "0", "0")],
               [("DEBIT", "10", "0", "0", "0", "0"), ("ODD", "1", "0", "0", "0", "0")]]
    write_files(spark, folder, batches, SCORE_REQUEST_TEXT)
    stream = spark.readStream.schema(SCORE_REQUEST_TEXT).option("maxFilesPerTrigger", 1).parquet(folder)
    scored, bad = str(tmp_path / "scored"), str(tmp_path / "bad")
    SS.run_scoring(stream, Fixed(), scored, bad, str(tmp_path / "c")).awaitTermination()
    found = spark.read.parquet(scored)
    assert sorted(rows(found, "type", "is_fraud")) == [("DEBIT", False), ("TRANSFER", True)]
    assert spark.read.parquet(bad).count() == 2
    # replaying every micro-batch from a fresh checkpoint overwrites, never doubles
    SS.run_scoring(stream, Fixed(), scored, bad, str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(scored).count() == 2


def test_label_stream_equals_batch(spark, tmp_path):
    scored = spark.createDataFrame([(i, minutes(i), i / 10) for i in range(10)], "txn_id long, ts timestamp, p double")
    labels = spark.createDataFrame(
        [(i, minutes(i + 60 * i), i % 2) for i in range(10)], "txn_id long, label_ts timestamp, y int")
    scored.write.parquet(str(tmp_path / "s"))
    labels.write.parquet(str(tmp_path / "l"))
    joined = SL.label_join(spark.readStream.schema(scored.schema).parquet(str(tmp_path / "s")),
                           spark.readStream.schema(labels.schema).parquet(str(tmp_path / "l")), within_hours=4)
    found, _ = run(spark, joined, tmp_path)
    batch = O.label_join(scored, labels, within_hours=4)
    assert sorted(rows(found, "txn_id", "y")) == sorted(rows(batch, "txn_id", "y"))
    assert 0 < found.count() < 10


def test_drift_stream_writes_one_result_per_batch(spark, sf, tmp_path):
    featured = X.add_features(D.transactions(spark, sf))
    names = ["ts", "type", "amount"]
    calm, odd = featured.where("step <= 240"), featured.where("step > 240").withColumn("amount", F.col("amount") * 50)
    folder = str(tmp_path / "f")
    for i, part in enumerate((calm, odd)):
        part.select(*names).coalesce(1).write.mode("append").parquet(folder)
        newest = max((os.path.join(folder, n) for n in os.listdir(folder) if n.startswith("part")), key=os.path.getmtime)
        os.utime(newest, (1_700_000_000 + i * 60,) * 2)
    stream = spark.readStream.schema(calm.select(*names).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    config = DriftConfig(numeric=("amount",), categorical=("type",))
    SD.run_drift(stream, calm, str(tmp_path / "out"), str(tmp_path / "c"), config).awaitTermination()
    found = rows(spark.read.parquet(str(tmp_path / "out")).where("feature = 'amount'").orderBy("batch_id"), "batch_id", "drift_detected")
    assert found == [(0, False), (1, True)]


def test_watermark_needs_a_cast_from_ntz(spark, sf):
    stream = D.requests_from(D.stream_events(spark, sf, only="events.parquet"))
    assert dict(stream.dtypes)["ts"] == "timestamp_ntz"
    assert dict(SM.watermarked(stream).dtypes)["ts"] == "timestamp"


@pytest.mark.parametrize("part", [SS.admitted, SS.quarantined])
def test_admission_is_stateless(spark, tmp_path, part):
    empty = spark.createDataFrame([], SCORE_REQUEST_TEXT)
    empty.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(SCORE_REQUEST_TEXT).parquet(str(tmp_path / "e"))
    _, query = run(spark, part(stream), tmp_path)
    assert all(not p.stateOperators for p in query.recentProgress)


def test_good_requests_close_the_windows_of_a_bad_one(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = f"{SCORE_REQUEST_TEXT.simpleString()[7:-1].replace(':', ' ')}, ts timestamp"
    good, bad = ("TRANSFER", "950", "0", "0", "0", "0"), ("ODD", "-5", "0", "0", "0", "0")
    batches = [[(*bad, minutes(0)), (*good, minutes(1))], *[[(*good, minutes(60 * h))] for h in (5, 6, 7, 8)]]
    write_files(spark, folder, batches, schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    found, query = run(spark, SM.quality_series(stream), tmp_path)
    batch = O.quality_errors_over_time(violations_long(spark.read.schema(schema).parquet(folder), ["ts"]))
    assert sorted(rows(found, *batch.columns)) == sorted(rows(batch)) and found.count() == 10
    # good requests are not kept
    assert max(op.numRowsTotal for p in query.recentProgress for op in p.stateOperators) <= 10


def test_invalid_scores_of_a_stream(spark, tmp_path):
    folder = str(tmp_path / "log")
    odd = [0.95, 0.1, float("nan"), 1.5, float("inf"), None]
    write_files(spark, folder, [[request(i, 0, 200, p) for i, p in enumerate(odd)] + [request(99, 60)]], REQUEST_LOG)
    found, _ = run(spark, SM.fraud_series(Q.stream_request_log(spark, folder)), tmp_path)
    assert set(rows(found, "fraud", "non_fraud", "invalid_scores", "fraud_rate")) == {(1, 1, 3, 0.5)}
    found, _ = run(spark, SM.probability_series(Q.stream_request_log(spark, folder)), tmp_path, "probability")
    assert set(rows(found, "le", "predictions")) == {("1", 1), ("0.1", 1)}
