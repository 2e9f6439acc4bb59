import pytest
from pyspark.sql import functions as F

from riskspark.config import FeatureConfig
from riskspark.errors import MissingTargetError
from riskspark.operators import features as X
from riskspark.sources.sinks import write_with_stage_report

DDL = "amount double, oldbalanceOrg double, newbalanceOrig double, oldbalanceDest double, newbalanceDest double"


@pytest.mark.parametrize("values, expected", [
    ((100.0, 1000.0, 900.0, 50.0, 150.0), (100.0, 100.0, 100 / 1001)),
    ((0.0, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0)),
    ((100.0, 1000.0, 900.0, 0.0, 100.0), (100.0, 100.0, 100 / 1001)),
    ((500.0, 0.0, 0.0, 200.0, 700.0), (0.0, 500.0, 500.0)),
])
def test_values(spark, values, expected):
    found = X.add_features(spark.createDataFrame([values], DDL)).first()
    assert (found.balance_diff_orig, found.balance_diff_dest, found.amount_to_balance_ratio) == expected


def test_division_by_zero_is_null(spark):
    found = X.add_features(spark.createDataFrame([(1.0, -1.0, 0.0, 0.0, 0.0)], DDL)).first()
    assert found.amount_to_balance_ratio is None


def test_switches_and_missing_inputs(raw):
    off = FeatureConfig(balance_diffs=False, amount_ratio=False)
    assert X.add_features(raw, off).columns == raw.columns
    assert X.add_features(raw.drop("newbalanceDest")).columns[-2:] == ["balance_diff_orig", "amount_to_balance_ratio"]


def test_clean_goes_from_11_to_10_columns(raw):
    cleaned = X.clean(raw)
    assert len(raw.columns) == 11 and len(cleaned.columns) == 10
    assert [r.isFraud for r in cleaned.collect()] == [0, 1]
    assert not set(cleaned.columns) & {"nameOrig", "nameDest", "isFlaggedFraud", "step"}
    assert len(X.preprocess(raw).columns) == 7
    assert X.features_and_target(cleaned)[1] == "isFraud"


def test_missing_target_is_an_error(raw):
    with pytest.raises(MissingTargetError, match="isFraud"):
        X.clean(raw.drop("isFraud"))


def test_clean_is_one_projection(raw):
    plan = X.clean(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_stage_reports(raw, tmp_path, spark):
    cleaned = X.clean(raw)
    assert X.stage_report(raw, cleaned, "clean").first().output_columns == 10
    path = str(tmp_path / "cleaned.parquet")
    written = write_with_stage_report(raw, X.clean, path, "clean").first()
    assert (written.input_rows, written.input_columns, written.output_columns, written.status) == (2, 11, 10, "SUCCESS")
    fewer = write_with_stage_report(raw, lambda df: df.where("step = 1"), str(tmp_path / "fewer"), "filter").first()
    assert (fewer.input_rows, fewer.output_rows) == (2, 1)
    counted = X.stage_report(raw, raw.where("step = 1"), "filter").first()
    assert (counted.input_rows, counted.output_rows) == (2, 1)
    assert written.features_created == ["balance_diff_orig", "balance_diff_dest", "amount_to_balance_ratio"]
    back = spark.read.parquet(path)
    assert back.columns == cleaned.columns and back.count() == 2
    assert back.where(F.col("isFraud") == 1).count() == 1


def test_one_hot_vectors_equal_one_hot_columns(spark):
    """Levels of a column in slots, sorted over several tasks; the first, unknown and null ones give zeros."""
    from pyspark.ml.functions import vector_to_array
    from riskspark.operators import encode as C

    table = spark.range(3000).selectExpr("id", "CASE WHEN id % 50 = 7 THEN NULL ELSE concat('l', id % 400) END AS k", "'x' AS level", "0 AS slot")
    levels, n = C.level_table(table, "k")
    names = sorted({r.k for r in table.collect()} - {None})
    assert n == len(names) and {r.level: r.slot for r in levels.collect()} == {v: (i - 1) % n for i, v in enumerate(names)}
    out = C.one_hot_vectors(table, "k")
    assert out.columns == ["id", "k", "level", "slot", "onehot"]
    for r in out.withColumn("a", vector_to_array("onehot")).where("id < 450").collect():
        at = names.index(r.k) - 1 if r.k else -1
        assert len(r.a) == n - 1 and [i for i, v in enumerate(r.a) if v] == ([at] if at >= 0 else [])
    one = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.onehot.toArray().tolist() for r in C.one_hot_vectors(one, "k").collect()] == [[0.0], [0.0]]
    none = spark.createDataFrame([], "k string")
    assert C.level_table(none, "k")[1] == 0 and C.one_hot_vectors(none, "k").count() == 0
