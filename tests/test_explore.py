import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from riskspark.operators import explore as E
from riskspark.sources import testdata as D


@pytest.fixture(scope="module")
def t(spark, sf):
    table = D.transactions(spark, sf).persist()
    yield table
    table.unpersist()


def test_counts_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    assert rows(E.top_values(df, "x", 2)) == [("c", 2), ("a", 1)]


def test_crosstab_margins(t):
    found = {r.type: r for r in E.crosstab_with_margins(t).collect()}
    assert found["All"].all_classes == t.count()
    assert found["All"].class_1 == sum(r.class_1 for k, r in found.items() if k != "All")


def test_describe_against_numpy(t):
    x = np.array([r.amount for r in t.select("amount").collect()])
    found = dict(rows(E.describe(t, "amount")))
    assert found["mean"] == pytest.approx(x.mean()) and found["std"] == pytest.approx(x.std(ddof=1))
    for name, q in (("25%", .25), ("50%", .5), ("75%", .75)):
        assert found[name] == pytest.approx(np.quantile(x, q))


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0)], "a double, b double, c double")
    found = {(r.a, r.b): r.corr for r in E.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert found["a", "b"] == found["b", "a"] == pytest.approx(1.0)
    assert found["a", "c"] is None and len(found) == 9


def test_nan_counts_as_missing(spark):
    from riskspark.operators.encode import categories, fit_scaler

    nan = float("nan")
    rows_ = [(1.0, 2.0, 0), (2.0, nan, 0), (3.0, 5.0, 1), (nan, 1.0, 1), (4.0, 4.0, 1), (7.0, 9.5, 0)]
    df = spark.createDataFrame(rows_, "a double, b double, y int")
    nulls = df.select(*[F.nanvl(c, F.lit(None)).alias(c) for c in ("a", "b")], "y")
    assert sorted(E.correlation_pairs(df, ["a", "b"]).collect()) == sorted(E.correlation_pairs(nulls, ["a", "b"]).collect())
    assert sorted(E.stats_by_class(df, "a", "y").collect()) == sorted(E.stats_by_class(nulls, "a", "y").collect())
    assert fit_scaler(df, ["a", "b"]) == fit_scaler(nulls, ["a", "b"])
    assert len(categories(spark.range(2000).selectExpr("CAST(id AS STRING) AS c"), "c")) == 2000


def test_correlation_over_the_rows_where_both_are_present(spark):
    values = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 1.0), (4.0, 4.0), (7.0, 9.5)]
    found = {(r.a, r.b): r.corr for r in E.correlation_pairs(spark.createDataFrame(values, "a double, b double"), ["a", "b"]).collect()}
    both = np.array([v for v in values if None not in v])
    assert found["a", "b"] == pytest.approx(np.corrcoef(both.T)[0, 1])
    assert found["a", "a"] == found["b", "b"] == 1.0


def test_sketches_stay_within_their_error(t):
    exact = dict(rows(E.cardinality(t, ["nameOrig", "nameDest", "type"])))
    for name, n in rows(E.approximate_cardinality(t, list(exact))):
        assert abs(n - exact[name]) <= max(1, 0.1 * exact[name])
    x = sorted(r.amount for r in t.select("amount").collect())
    for q, v in rows(E.approximate_quantiles(t, "amount", [.25, .5, .75])):
        assert abs(sum(a <= v for a in x) / len(x) - q) < 0.01


def test_histogram_counts_every_row(t):
    found = E.log_histogram(t, F.col("amount") + 1).collect()
    assert len(found) == 50 and sum(r.rows for r in found) == t.count()
    one = t.sparkSession.createDataFrame([(3.0,)] * 4, "amount double")
    assert sum(r.rows for r in E.log_histogram(one, F.col("amount")).collect()) == 4


def test_box_summary(spark):
    df = spark.createDataFrame([(0, float(v)) for v in (1, 2, 3, 4, 100)], "isFraud int, x double")
    r = E.box_summary(df, F.col("x")).first()
    assert (r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.outliers) == (2, 3, 4, 1, 4, 1)


def test_drained_and_type_filter(t):
    found = E.type_filter_effect(t).first()
    assert found.fraud_kept == found.fraud
    assert E.drained_counts(t).first().drained_fraud == found.fraud
    assert E.flag_rule_efficiency(t).first().missed <= found.fraud


def test_log_helpers(spark):
    df = spark.createDataFrame([(math.e - 1, 5.0, 5.0 + math.e - 1)], "amount double, oldbalanceOrg double, newbalanceOrig double")
    assert rows(df.select(E.log_amount(), E.log_balance_change())) == [(pytest.approx(1.0), pytest.approx(1.0))]
