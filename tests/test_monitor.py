import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from riskspark.operators import monitor as O

LOG = "path string, method string, status int, latency_ms double"
START = dt.datetime(2024, 1, 1)


def predictions(spark, values):
    return spark.createDataFrame([(v,) for v in values], "probability double")


def test_request_and_latency_totals(spark):
    log = spark.createDataFrame([("/predict", "POST", 200, 12.5), ("/health", "GET", 503, 4.0)], LOG)
    assert rows(O.request_totals(log)) == [(2, 1, 0.5)]
    assert rows(O.latency_summary(log)) == [(2, 8.25, 4.0, 12.5)]
    assert dict(rows(O.requests_by_endpoint(log))) == {"POST /predict": 1, "GET /health": 1}
    assert dict(rows(O.requests_by_status(log))) == {"200": 1, "503": 1}
    assert rows(O.error_classes(log)) == [("GET", "/health", "5xx", 1)]


def test_empty_log_gives_zeros(spark):
    log = spark.createDataFrame([], LOG)
    assert rows(O.request_totals(log)) == [(0, 0, 0.0)]
    assert rows(O.latency_summary(log)) == [(0, 0.0, 0.0, 0.0)]
    found = O.prediction_summary(predictions(spark, [])).first()
    assert (found.total, found.fraud_rate, found.average_probability, found.min_probability) == (0, 0.0, 0.0, None)


def test_prediction_summary(spark):
    found = O.prediction_summary(predictions(spark, [.95, .20, None])).first()
    assert (found.total, found.fraud, found.fraud_rate, found.below_threshold, found.at_or_above_threshold) == (2, 1, .5, 1, 1)
    assert found.average_probability == pytest.approx(.575)


def test_cumulative_histogram(spark):
    found = dict(rows(O.probability_histogram(predictions(spark, [0.0, .05, .1, .95, 1.0])), "le", "cumulative"))
    assert (found["0"], found["0.1"], found["0.9"], found["1"], found["+Inf"]) == (1, 3, 3, 5, 5)


def test_bucket_quantile(spark):
    log = spark.createDataFrame([(START, float(v)) for v in (1, 2, 3, 4)] + [(START, 60.0)], "ts timestamp, latency_ms double")
    windows = O.latency_quantile(log, 0.5, bounds=(5.0, 50.0)).collect()
    assert len(windows) == 5
    assert all(r.quantile_ms == pytest.approx(2.5 / 4 * 5) and r.requests == 5 for r in windows)
    assert O.latency_quantile(log, 0.95, bounds=(5.0, 50.0)).first().quantile_ms == 50.0


def test_exact_quantile_per_window(spark):
    log = spark.createDataFrame([(START, float(v)) for v in range(1, 21)], "ts timestamp, latency_ms double")
    assert rows(O.exact_latency_quantile(log, 0.95, buckets=3), "requests", "quantile_ms") == [(20, pytest.approx(19.05))]


@pytest.mark.parametrize(("minutes", "slide"), [(5, 1), (5, 2), (6, 4), (5, 5), (60, 7)])
def test_sliding_equals_the_built_in_window(spark, minutes, slide):
    log = spark.range(500).select(
        (F.lit(START) + F.make_dt_interval(secs=(F.col("id") * 37 % 3600).cast("decimal(18,6)"))).alias("ts"),
        F.when(F.col("id") % 5 == 0, 500).otherwise(200).alias("status"))
    ours = O.sliding(log, O.request_sums(), minutes=minutes, slide=slide).select("window_start", "window_end", "requests", "errors")
    plain = log.groupBy(F.window("ts", f"{minutes} minutes", f"{slide} minutes").alias("w")).agg(
        F.count("*").alias("requests"), F.count_if(O.is_error()).alias("errors")
    ).select("w.start", "w.end", "requests", "errors")
    assert sorted(rows(ours)) == sorted(rows(plain))
    # rows collapse into panes before anything is copied into windows
    plan = ours._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and "Expand" not in plan[plan.rindex("Aggregate"):]


def test_label_join_respects_the_delay(spark):
    scored = spark.createDataFrame([(1, START, .95), (2, START, .10), (3, START, .99)], "txn_id long, ts timestamp, p double")
    hour = dt.timedelta(hours=1)
    labels = spark.createDataFrame(
        [(1, START + hour, 1), (2, START + 80 * hour, 1)], "txn_id long, label_ts timestamp, y int")
    found = O.online_performance(scored, labels).first()
    assert (found.tp, found.fn, found.precision) == (1, 0, 1.0)


def test_exact_quantile_per_sliding_window(spark):
    log = spark.createDataFrame([(START + dt.timedelta(minutes=m), float(m)) for m in range(10)], "ts timestamp, latency_ms double")
    found = dict(rows(O.exact_latency_quantile(log, 0.5, minutes=5, slide=1), "window_start", "quantile_ms"))
    assert len(found) == 14 and found[START] == 2.0 and found[START - dt.timedelta(minutes=4)] == 0.0


def test_scores_that_are_none_are_reported_only(spark):
    log = predictions(spark, [.95, .2, float("nan"), 1.5, float("inf"), -.1, None])
    found = O.prediction_summary(log).first()
    assert (found.total, found.fraud, found.non_fraud, found.invalid_scores, found.max_probability) == (2, 1, 1, 4, .95)
    buckets = {r.le: (r.cumulative, r.invalid_scores) for r in O.probability_histogram(log).collect()}
    assert buckets["+Inf"] == buckets["1"] == (2, 4)
    timed = log.withColumn("ts", F.lit(START))
    assert {(r.fraud, r.non_fraud, r.invalid_scores, r.fraud_rate) for r in O.fraud_rate(timed).collect()} == {(1, 1, 4, .5)}
    assert {r.le for r in O.probability_heatmap(timed).collect()} == {"0.2", "1"}


def test_latencies_that_were_not_measured(spark):
    values = [1.0, 3.0, float("nan"), float("inf"), None]
    log = spark.createDataFrame([(START, v) for v in values], "ts timestamp, latency_ms double")
    assert rows(O.latency_summary(log)) == [(2, 2.0, 1.0, 3.0)]
    assert dict(rows(O.latency_histogram(log, (2.0,)), "le", "cumulative")) == {"2": 1, "+Inf": 2}
    assert {r.requests for r in O.latency_quantile(log).collect()} == {2}
    assert {(r.requests, r.quantile_ms) for r in O.exact_latency_quantile(log, 0.5, 5, 1).collect()} == {(2, 2.0)}


@pytest.fixture(scope="module")
def spread_log(spark):
    return spark.range(6000).select(
        (F.lit(START) + F.make_dt_interval(secs=(F.col("id") * 37 % 3600).cast("decimal(18,6)"))).alias("ts"),
        F.when(F.col("id") % 3 == 0, 50.0).otherwise((F.col("id") * 7919 % 1009).cast("double")).alias("latency_ms")).persist()


@pytest.mark.parametrize(("minutes", "slide"), [(5, 1), (6, 4)])
def test_exact_quantile_without_copied_rows(spread_log, minutes, slide, monkeypatch):
    monkeypatch.setattr("riskspark.plans.ordered.SKETCH_SHARE", 1.0)
    ours = O.exact_latency_quantile(spread_log, 0.95, minutes, slide, buckets=12)
    plain = spread_log.groupBy(F.window("ts", f"{minutes} minutes", f"{slide} minutes").alias("w")).agg(
        F.count("*").alias("requests"), F.expr("percentile(latency_ms, 0.95)").alias("q")).select("w.start", "requests", "q")
    assert sorted(rows(ours, "window_start", "requests", "quantile_ms")) == [(a, n, pytest.approx(x)) for a, n, x in sorted(rows(plain))]
    # windows multiply counts per pane and bucket only
    plan = ours._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan[plan.rindex("Aggregate"):] and "Range" not in plan


def test_sketched_quantile_within_its_rank_error(spread_log):
    found = {r.window_start: r for r in O.sketched_latency_quantile(spread_log, 0.95, 15, 5).collect()}
    windows = spread_log.groupBy(F.window("ts", "15 minutes", "5 minutes").alias("w")).agg(F.sort_array(F.collect_list("latency_ms")).alias("v")).collect()
    assert len(windows) == len(found) > 10
    for r in windows:
        f, n = found[r.w.start], len(r.v)
        low, high = sum(x < f.quantile_ms for x in r.v) / n, sum(x <= f.quantile_ms for x in r.v) / n
        assert f.requests == n and low - 0.03 <= 0.95 <= high + 0.03
