import math
import re

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import rows
from riskspark.config import NUMERIC_FEATURES, Experiment, ModelConfig
from riskspark.errors import DataValidationError, ScoringError
from riskspark.operators import encode as C, features as X, metrics as M, split as P, train as L
from riskspark.plans import jobs as J
from riskspark.sources import testdata as D

TINY = ModelConfig(trees=3, depth=3)


@pytest.fixture(scope="module")
def transactions(spark, sf):
    table = D.transactions(spark, sf).persist()
    yield table
    table.unpersist()


@pytest.fixture(scope="module")
def fitted(transactions):
    train, test = P.train_test(transactions, "txn_id")
    return L.fit(train, "txn_id", model=TINY), test


def test_one_hot_drops_the_first_level_and_zeroes_unknowns(spark):
    table = spark.createDataFrame([("CASH_IN",), ("TRANSFER",), ("NEW",), (None,)], "type string")
    hot = C.one_hot("type", ["TRANSFER", "CASH_IN", "DEBIT"])
    assert list(hot) == ["type_DEBIT", "type_TRANSFER"]
    assert rows(table.select(*hot.values())) == [(0.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0)]


def test_constant_column_scales_to_zero(spark):
    table = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert rows(C.standardize(table, ["a", "b"])) == [(-1.0, 0.0), (1.0, 0.0)]


def test_columns_by_type(raw):
    cleaned = X.clean(raw)
    assert C.categorical_columns(cleaned) == ["type"]
    assert set(C.numeric_columns(cleaned)) == {*NUMERIC_FEATURES, "isFraud"}


def test_stage_encoding_equals_the_columns(transactions):
    featured = X.add_features(transactions)
    scaler = C.fit_scaler(featured)
    from pyspark.ml import Pipeline

    stages = [C.feature_stage(), *C.encode_stages(scaler)]
    vector = Pipeline(stages=stages).fit(transactions).transform(transactions).select(
        "txn_id", vector_to_array("features").alias("a"))
    want = featured.select("txn_id", F.array(*[scaler.column(c) for c in NUMERIC_FEATURES],
                                             *C.one_hot("type", C.TRANSACTION_TYPES).values()).alias("b"))
    apart = vector.join(want, "txn_id").select(F.aggregate(
        F.zip_with("a", "b", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda acc, x: acc + x).alias("d"))
    assert apart.agg(F.max("d")).first()[0] < 1e-9


def test_model_separates_the_classes(fitted):
    model, test = fitted
    scored = L.score(test, model, keep=["txn_id", "isFraud"])
    assert scored.count() == test.count()
    auc = M.roc_auc(scored.withColumnsRenamed({"isFraud": "y", "fraud_probability": "p"})).first().roc_auc
    assert auc > 0.9


def test_saved_model_scores_alike(fitted, tmp_path):
    model, test = fitted
    again = L.load_model(L.save_model(model, str(tmp_path / "m")))
    one = sorted(rows(L.score(test, model, keep=["txn_id"])))
    assert one == sorted(rows(L.score(test, again, keep=["txn_id"])))
    # scoring needs the six request fields only, and unknown types are no error
    request = test.sparkSession.createDataFrame([("NEW", 1.0, 1.0, 0.0, 0.0, 1.0)],
        "type string, amount double, oldbalanceOrg double, newbalanceOrig double, oldbalanceDest double, newbalanceDest double")
    assert 0 <= L.score(request, again).first().fraud_probability <= 1


def test_threshold_is_inclusive(spark):
    table = spark.createDataFrame([(.9,), (.89,), (float("nan"),)], "p double")
    assert rows(table.select(L.decide(F.col("p"), .9))) == [(True,), (False,), (False,)]


def test_a_model_without_two_classes_is_refused(fitted):
    class Odd:
        numClasses = 1

    with pytest.raises(ScoringError):
        L._require_binary(Odd())


def test_training_job_writes_everything(spark, transactions, tmp_path):
    both = [Experiment("smote_only", True, False), Experiment("scale_weight_only", False, True)]
    out = str(tmp_path / "run")
    model, report = J.train_job(transactions, out, "txn_id", experiments=both, model=TINY, min_recall=.1, model_name="detector")
    assert report.count() == 2 and report.where("is_selected").count() == 1
    assert L.load_model(f"{out}/model").stages[-1].getNumTrees == model.stages[-1].getNumTrees == 3
    scored = spark.read.parquet(f"{out}/scored")
    assert dict(rows(scored.groupBy("experiment").count())) == {e.name: 300 for e in both}
    assert spark.read.json(f"{out}/metadata").where("selected").count() == 5


GRID = {"maxIter": (1, 2), "maxDepth": (2,), "stepSize": (.1,), "subsamplingRate": (1.0,), "columnShare": (1.0,)}


def test_search_reports_every_draw(transactions):
    fitted, table = L.search(transactions, "txn_id", draws=5, folds=2, grid=GRID, use_smote=False)
    assert table.count() == 2 and fitted.bestModel.stages[-1].getNumTrees in (1, 2)


def test_search_fits_encoding_and_oversampling_per_fold(spark, transactions):
    grid = {**GRID, "maxIter": (1,)}
    fitted, _ = L.search(transactions, "txn_id", draws=1, folds=2, grid=grid, keep_models=True)
    folds = F.pmod(F.xxhash64("txn_id", F.lit(42)), F.lit(2)).cast("int")
    whole = L.fit(transactions, "txn_id", model=ModelConfig(trees=1, depth=2)).stages[1].getStatement()
    statements = [models[0].stages[1].getStatement() for models in fitted.subModels]
    assert len({whole, *statements}) == 3  # the scaler's numbers are in the statement
    for fold, models in enumerate(fitted.subModels):
        held_out = transactions.where(folds == fold).select("txn_id")
        made = spark.read.parquet(models[0].synthetic_path)
        assert made.count() > 0
        for side in ("base", "neighbour"):
            assert made.join(held_out, made[side] == held_out.txn_id, "left_semi").isEmpty()


def log_loss(scored):
    p = F.greatest(F.least(F.col(L.PROBABILITY), F.lit(1 - 1e-15)), F.lit(1e-15))
    return scored.agg(F.avg(F.when(F.col("isFraud") == 1, -F.ln(p)).otherwise(-F.ln(1 - p)))).first()[0]


def test_columns_are_drawn_per_tree_and_the_loss_is_no_worse(transactions, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import GBTClassifier

    train, test = P.train_test(transactions, "txn_id")
    config = ModelConfig(trees=12, depth=3, learning_rate=0.3, column_subsample=0.5)
    model = L.fit(train, "txn_id", model=config, use_class_weight=False)
    names = model.stages[-2].getInputCols()
    drawn = model.tree_columns
    assert len(drawn) == 12 and {len(d) for d in drawn} == {6} and len(set(map(tuple, drawn))) > 6
    # no tree splits on a column it was not given
    for tree, given in zip(model.stages[-1].trees, drawn, strict=True):
        used = {names[int(x)] for x in re.findall(r"feature (\d+)", tree.toDebugString)}
        assert used <= set(given)
    L.save_model(model, str(tmp_path / "m"))
    assert L.load_tree_columns(transactions.sparkSession, str(tmp_path / "m")) == drawn
    prepared = PipelineModel(stages=model.stages[:-1])
    plain = GBTClassifier(featuresCol="features", labelCol="isFraud", maxIter=12, maxDepth=3, stepSize=0.3, subsamplingRate=0.8,
                          featureSubsetStrategy="0.5", seed=42).fit(prepared.transform(train))
    theirs = log_loss(L.score(test, PipelineModel(stages=[*prepared.stages, plain]), keep=["isFraud"]))
    assert log_loss(L.score(test, model, keep=["isFraud"])) <= theirs


def test_one_step_is_the_newton_step(spark):
    """One tree of depth 1 from p = 1/2: a leaf's log odds are the mean of 4 (y - 1/2), at most the bound."""
    table = [(0.0, 1)] * 3 + [(0.0, 0)] * 5 + [(1.0, 1)] * 6 + [(1.0, 0)] * 2
    rows_ = spark.createDataFrame([(x, y, 1.0) for x, y in table], "x double, isFraud int, weight double").select(
        F.expr("array(x)").alias("a"), "isFraud", "weight")
    from pyspark.ml.functions import array_to_vector

    rows_ = rows_.select(array_to_vector("a").alias("features"), "isFraud", "weight")
    model, drawn = L.boost(rows_, config=ModelConfig(trees=1, depth=1, learning_rate=1.0, row_subsample=1.0, column_subsample=1.0))
    assert drawn == [[0]]
    found = {(r.features[0]): r.p for r in model.transform(rows_).select("features", vector_to_array("probability")[1].alias("p")).collect()}
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    assert found[0.0] == pytest.approx(sigmoid((3 * 2 - 5 * 2) / 8)) and found[1.0] == pytest.approx(sigmoid((6 * 2 - 2 * 2) / 8))


def test_retraining_gate(spark, sf, tmp_path, fitted):
    raw = D.raw_transactions(spark, sf)
    out = str(tmp_path / "retrain")
    log = J.retrain_job(raw, fitted[0], out, model=TINY).collect()
    assert len(log) == 1 and log[0].decision in ("PROMOTE", "REJECT")
    assert log[0].candidate_roc_auc is not None
    with pytest.raises(DataValidationError):
        J.retrain_job(raw.withColumn("amount", F.lit(-1.0)), fitted[0], out, model=TINY)


def test_prepare_and_drift_jobs(spark, sf, tmp_path):
    raw = D.raw_transactions(spark, sf)
    out = str(tmp_path)
    report = J.prepare_job(raw, out).orderBy("stage").collect()
    assert [(r.stage, r.input_columns, r.output_columns) for r in report] == [("features", 7, 10), ("preprocess", 11, 7)]
    assert report[0].output_rows == raw.count()
    cleaned = f"{out}/cleaned.parquet"
    same = J.drift_job(spark, cleaned, cleaned, f"{out}/drift").first()
    assert (same.drifted, same.dataset_drift_detected) == (0, False)
    sampled = J.drift_job(spark, cleaned, cleaned, f"{out}/drift2", sample_size=100).first()
    assert (sampled.reference_rows, sampled.drifted) == (100, 0)


def test_validation_job(spark, sf, tmp_path):
    D.raw_transactions(spark, sf).write.option("header", True).csv(str(tmp_path / "ok.csv"))
    assert J.validate_job(spark, str(tmp_path / "ok.csv"), str(tmp_path / "r1")).count() > 20
    D.dirty(spark, sf).drop("txn_id", "amount_cents_text").write.option("header", True).csv(str(tmp_path / "bad.csv"))
    with pytest.raises(DataValidationError):
        J.validate_job(spark, str(tmp_path / "bad.csv"), str(tmp_path / "r2"))
    for name, content in (("broken.csv.gz", b"\x1f\x8b\x08\x00no gzip stream"), ("other.csv", b"\x00\x01PAR1\xff")):
        (tmp_path / name).write_bytes(content)
        with pytest.raises(DataValidationError):
            J.validate_job(spark, str(tmp_path / name), str(tmp_path / f"r-{name}"))


def test_jobs_refuse_scores_that_are_no_probability(spark):
    inputs = spark.createDataFrame([(i,) for i in range(4)], "k long")
    good = spark.createDataFrame([(i, .5) for i in range(4)], "k long, p double")
    J.require_scored(inputs, good, "k", "p", "good")
    for bad in (good.withColumn("p", F.lit(float("nan"))), good.withColumn("p", F.lit(1.5)), good.where("k > 0"), good.unionAll(good)):
        with pytest.raises(ScoringError):
            J.require_scored(inputs, bad, "k", "p", "bad")
