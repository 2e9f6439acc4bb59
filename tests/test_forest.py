import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskspark.config import ModelConfig
from riskspark.operators import forest, train as L


def table(spark, n=3000, size=5):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, size)).round(2)
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0.5).astype(int)
    return spark.createDataFrame([(i, a.tolist(), int(b), 1.0) for i, (a, b) in enumerate(zip(x, y))],
                                 "id int, a array<double>, isFraud int, weight double").select(
        "id", array_to_vector("a").alias("features"), "isFraud", "weight")


def by_mllib(model, rows):
    return {r.id: r.p for r in model.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).collect()}


def by_score(model, rows):
    return {r.id: r.fraud_probability for r in L.score(rows, PipelineModel(stages=[model]), keep=["id"]).collect()}


@pytest.mark.parametrize("depth", [1, 3, 10])
def test_batches_score_as_mllib_does(spark, depth):
    rows = table(spark)
    model, _ = L.boost(rows, config=ModelConfig(trees=12, depth=depth, learning_rate=0.3))
    want, got = by_mllib(model, rows), by_score(model, rows)
    assert want.keys() == got.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_trees_that_are_one_leaf_and_rows_at_a_bound_or_without_a_number(spark):
    same = table(spark).withColumn("isFraud", F.lit(1))
    model, _ = L.boost(same, config=ModelConfig(trees=3, depth=2))
    assert by_score(model, same) == pytest.approx(by_mllib(model, same))
    model, _ = L.boost(table(spark), config=ModelConfig(trees=5, depth=4))
    bounds = sorted({b for m in forest.members(model) for _, b in m.splits})
    odd = [[b] * 5 for b in (*bounds, float("nan"), float("inf"), -float("inf"), -0.0)]
    rows = spark.createDataFrame(list(enumerate(odd)), "id int, a array<double>").select("id", array_to_vector("a").alias("features"))
    assert by_score(model, rows) == pytest.approx(by_mllib(model, rows))


def test_other_models_score_as_before(spark):
    rows = table(spark)
    model = RandomForestClassifier(labelCol="isFraud", numTrees=3, seed=1).fit(rows)
    assert by_score(model, rows) == by_mllib(model, rows)


def test_no_row_goes_through_mllibs_trees(spark):
    rows = table(spark)
    model, _ = L.boost(rows, config=ModelConfig(trees=2, depth=2))
    assert isinstance(model, GBTClassificationModel)
    plan = L.score(rows, PipelineModel(stages=[model]), keep=["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "rawPrediction" not in plan
    assert L.score(rows.limit(0), PipelineModel(stages=[model]), keep=["id"]).count() == 0
