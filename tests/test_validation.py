import pytest
from pyspark.sql import functions as F

from conftest import RAW_DDL, RAW_ROWS, rows
from riskspark.config import ValidationRules
from riskspark.errors import DataValidationError
from riskspark.operators import validate as V
from riskspark.sources import testdata as D


def status(report, check, item=None):
    found = report.where(F.col("check") == check)
    found = found.where(F.col("item").isNull()) if item is None else found.where(F.col("item") == item)
    return found.first()


def overall(df):
    return V.overall_status(V.validate(df).persist())


def test_valid_table_passes(raw):
    report = V.validate(raw).persist()
    assert V.overall_status(report) == "PASSED"
    assert status(report, "target_column", "fraud").value == 1
    assert status(report, "target_column", "non_fraud").value == 1
    assert V.require_valid(raw) is raw


@pytest.mark.parametrize("column", ["isFraud", "nameDest"])
def test_missing_column_fails(raw, column):
    report = V.validate(raw.drop(column)).persist()
    assert V.overall_status(report) == "FAILED"
    assert status(report, "schema", column).detail == "missing column"
    assert V.missing_columns(raw.drop(column), V.ValidationRules().required) == [column]


def test_unexpected_column_is_only_reported(raw):
    report = V.validate(raw.withColumn("extra", F.lit(1))).persist()
    assert V.overall_status(report) == "PASSED"
    assert status(report, "schema", "extra").status == "INFO"


@pytest.mark.parametrize("value", [99, 2])
def test_target_outside_domain_fails(raw, value):
    bad = raw.withColumn("isFraud", F.when(F.col("isFraud") == 1, value).otherwise(0))
    assert overall(bad) == "FAILED"
    assert V.target_domain(bad).where("NOT allowed").first().value == value


def test_two_broken_minimums_are_two_issues(raw):
    bad = raw.withColumns({
        "amount": F.when(F.col("step") == 1, -1.0).otherwise(F.col("amount")),
        "oldbalanceOrg": F.when(F.col("step") == 1, -0.01).otherwise(F.col("oldbalanceOrg")),
    })
    assert V.sanity_report(bad).where("status = 'FAILED'").count() == 2
    with pytest.raises(DataValidationError, match="amount"):
        V.require_valid(bad)


def test_step_zero_fails(raw):
    bad = raw.withColumn("step", F.lit(0).cast("long"))
    assert V.sanity_report(bad).where("column = 'step'").first().violations == 2
    assert overall(bad) == "FAILED"


def test_zero_amount_is_valid(raw):
    assert overall(raw.withColumn("amount", F.lit(0.0))) == "PASSED"


def test_nulls_and_nan_only_warn(spark):
    table = spark.createDataFrame([(None, *RAW_ROWS[0][1:]), (1, "PAYMENT", float("nan"), *RAW_ROWS[0][3:])], RAW_DDL)
    report = V.validate(table).persist()
    assert status(report, "null_values").value == 2
    assert status(report, "null_values").status == "WARNING"
    assert V.overall_status(report) == "PASSED"


def test_duplicates_only_warn(spark):
    table = spark.createDataFrame([*RAW_ROWS, RAW_ROWS[0], RAW_ROWS[0]], RAW_DDL)
    found = V.duplicate_count(table).first()
    assert (found.duplicates, found.status) == (2, "WARNING")
    assert overall(table) == "PASSED"


def test_duplicates_with_nulls_zeros_and_shifted_values(spark):
    rows = [("a", None, 0.0), (None, "a", 0.0), ("a", None, -0.0), ("b", "c", float("nan")), ("b", "c", float("nan"))]
    table = spark.createDataFrame(rows, "x string, y string, z double")
    # -0.0 equals 0.0, NaN equals NaN, null equals null; swapped columns are no copy
    assert V.duplicate_count(table).first().duplicates == 2


def test_many_repeated_hashes_use_the_shuffled_join(spark, monkeypatch):
    table = spark.range(40).selectExpr("id % 10 AS a", "id % 5 AS b")
    monkeypatch.setattr(V, "LITERAL_HASHES", 3)
    assert V.duplicate_count(table).first().duplicates == 30


def test_text_in_numeric_column_fails_types(raw):
    bad = raw.withColumn("amount", F.lit("x"))
    report = V.validate(bad).persist()
    assert status(report, "data_types", "amount").status == "FAILED"
    assert V.overall_status(report) == "FAILED"


def test_empty_table_fails_with_null_percentages(spark):
    empty = spark.createDataFrame([], RAW_DDL)
    report = V.validate(empty).persist()
    assert V.overall_status(report) == "FAILED"
    assert status(report, "dataset_size", "rows").status == "FAILED"
    assert V.null_report(empty).where("null_percent IS NOT NULL").count() == 0


def test_unreadable_csv_gives_a_failed_report(spark, tmp_path):
    report = V.validate_csv(spark, str(tmp_path / "none.csv"))
    assert V.overall_status(report.withColumn("check", F.lit("overall"))) == "FAILED"
    assert report.first().detail.startswith("no file at")


def test_csv_file_validates(spark, raw, tmp_path):
    path = str(tmp_path / "t.csv")
    raw.coalesce(1).write.option("header", True).csv(path)
    assert V.overall_status(V.validate_csv(spark, path)) == "PASSED"


def test_class_distribution_counts_null_targets_in_the_base(spark):
    table = spark.createDataFrame([(0,), (0,), (1,), (None,)], "isFraud int")
    found = V.class_distribution(table).first()
    assert (found.rows, found.fraud, found.non_fraud, found.fraud_percent, found.imbalance_ratio) == (4, 1, 2, 25.0, 2.0)


def test_text_columns_are_typed_in_one_pass(spark, raw, tmp_path):
    text = spark.createDataFrame(
        [("1", "1.5", "true", "2024-01-02", "2024-01-02 03:04:05", "x", None), ("-7", "NaN", "false", "2024-02-03", "2024-02-03", "1", None),
         (None, "2", None, None, None, None, None)], "a string, b string, c string, d string, e string, f string, g string")
    types, counts = V.text_profile(text, ValidationRules(target="a", minimums={"a": 0, "b": 2, "f": 5}))
    assert [t.simpleString() for t in types.values()] == ["bigint", "double", "boolean", "timestamp", "timestamp", "string", "string"]
    assert [counts[f"null__{c}"] for c in "abcdefg"] == [1, 1, 1, 1, 1, 1, 3]
    assert (counts["rows"], counts["low__a"], counts["low__b"], counts["bad_target"], counts["fraud"]) == (3, 1, 1, 1, 1)


def test_csv_report_equals_that_of_the_typed_table(spark, sf, tmp_path):
    path = str(tmp_path / "t.csv")
    dirty = D.dirty(spark, sf).drop("txn_id", "amount_cents_text")
    dirty.write.option("header", True).csv(path)
    inferred = spark.read.option("header", True).option("inferSchema", True).csv(path)
    names = ("check", "item", "status", "value")
    want = {r for r in rows(V.validate(inferred), *names)}
    assert {r for r in rows(V.validate_csv(spark, path), *names)} == want


def test_csv_types_need_no_inference_job(spark, raw, tmp_path):
    from riskspark.sources.readers import read_csv_text_or_report

    path = str(tmp_path / "t.csv")
    raw.write.option("header", True).csv(path)
    table, _ = read_csv_text_or_report(spark, path)
    assert {t for _, t in table.dtypes} == {"string"}
    found = {r.item: r.status for r in V.validate_csv(spark, path).where("check = 'data_types' AND item IS NOT NULL").collect()}
    assert found["amount"] == found["type"] == found["isFraud"] == "PASSED"
    raw.withColumn("amount", F.lit("much")).write.option("header", True).csv(path + "2")
    assert V.validate_csv(spark, path + "2").where("check = 'data_types' AND item = 'amount'").first().status == "FAILED"
