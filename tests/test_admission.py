import pytest
from pyspark.sql import functions as F

from conftest import rows
from riskspark.errors import DriftDataError
from riskspark.operators import admission as A, features as X
from riskspark.schema import SCORE_REQUEST_TEXT

VALID = ("TRANSFER", "1000", "1000", "0", "0", "1000")


def categories(spark, *values):
    table = spark.createDataFrame(values, SCORE_REQUEST_TEXT)
    return sorted(r.category for r in A.violations_long(table).collect())


def test_valid_request_is_admitted_and_parsed(spark):
    table = spark.createDataFrame([VALID], SCORE_REQUEST_TEXT).withColumn("isFraud", F.lit(1))
    valid, bad = A.admit(table)
    assert bad.count() == 0
    assert valid.first().amount == 1000.0 and "isFraud" in valid.columns


@pytest.mark.parametrize("request_row, expected", [
    (("TRANSFER", "-1", "0", "0", "0", "0"), ["invalid_amount"]),
    (("TRANSFER", None, "0", "0", "0", "0"), ["missing_field"]),
    (("UNKNOWN", "1", "0", "0", "0", "0"), ["invalid_type"]),
    (("TRANSFER", "one hundred", "0", "0", "0", "0"), ["invalid_amount"]),
    (("TRANSFER", "1", "-1", "x", "0", "0"), ["invalid_balance", "invalid_balance"]),
    (("UNKNOWN", None, None, None, None, None), ["invalid_type"] + ["missing_field"] * 5),
    (("TRANSFER", "0", "0", "0", "0", "0"), []),
    (("TRANSFER", "NaN", "0", "0", "0", "0"), ["invalid_amount"]),
])
def test_categories(spark, request_row, expected):
    assert categories(spark, request_row) == expected


def test_absent_columns_count_as_missing(spark):
    table = spark.createDataFrame([("UNKNOWN",)], "type string")
    found = rows(A.count_by_category(A.violations_long(table)).orderBy("category"))
    assert found == [("invalid_type", 1), ("missing_field", 5)]


def test_unknown_labels_count_as_invalid_type(spark):
    table = spark.createDataFrame([("missing_field",), ("invalid_amount",), ("odd",)], "category string")
    assert dict(rows(A.count_by_category(table))) == {"missing_field": 1, "invalid_amount": 1, "invalid_type": 1}


def test_drift_input_errors_name_the_feature(raw):
    table = X.add_features(raw)
    assert A.require_drift_input(table) == 2
    with pytest.raises(DriftDataError, match="amount"):
        A.require_drift_input(table.drop("amount"))
    with pytest.raises(DriftDataError, match="amount"):
        A.require_drift_input(table.withColumn("amount", F.lit(float("inf"))))
    with pytest.raises(DriftDataError, match="numeric"):
        A.require_drift_input(table.withColumn("amount", F.lit("1")))
    with pytest.raises(DriftDataError, match="type"):
        A.require_drift_input(table.withColumn("type", F.lit(None).cast("string")))
    with pytest.raises(DriftDataError, match="empty"):
        A.require_drift_input(table.where("1 = 0"))


def test_scored_sanity(spark):
    good = spark.createDataFrame([(0.0,), (1.0,)], "p double")
    assert A.scored_sanity(good, "p").first().valid
    bad = spark.createDataFrame([(0.5,), (float("nan"),), (None,), (float("inf"),), (1.5,), (-0.1,)], "p double")
    found = A.scored_sanity(bad, "p").first()
    assert (found.non_finite, found.outside_unit_interval, found.valid) == (3, 3, False)


def test_lost_rows(spark):
    inputs = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    scored = spark.createDataFrame([(1,), (3,), (3,)], "id int")
    assert sorted(rows(A.lost_rows(inputs, scored, "id"))) == [(2, 1, 0), (3, 1, 2)]


def test_admission_is_compiled_and_says_what_the_violations_say(spark):
    texts = ("1", "-1", "0", "-0.0", "NaN", "Infinity", "-Infinity", "1e400", " 2 ", "x", "", None)
    fields = SCORE_REQUEST_TEXT.names
    values = [("TRANSFER", *["1"] * 5)] + [("TRANSFER", *[t if i == j else "1" for i in range(5)]) for j in range(5) for t in texts]
    values += [(kind, *["1"] * 5) for kind in ("UNKNOWN", None, "", "transfer", "DEBIT")]
    table = spark.createDataFrame(values, SCORE_REQUEST_TEXT)
    numbers = table.select("type", *[F.col(c).try_cast("double").alias(c) for c in fields[1:]])
    for t in (table, numbers, table.drop("amount"), numbers.drop("type")):
        keyed = t.withColumn("key", F.monotonically_increasing_id()).persist()
        checked = {r.key: len(r.violations) for r in A.with_violations(keyed).collect()}
        valid, bad = A.admit(keyed)
        assert {r.key for r in valid.collect()} == {k for k, n in checked.items() if not n}
        assert {r.key: len(r.violations) for r in bad.collect()} == {k: n for k, n in checked.items() if n}
        keyed.unpersist()
    plan = A.admit(table)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and "size(" not in plan
