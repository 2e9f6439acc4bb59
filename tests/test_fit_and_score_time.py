import pytest

from conftest import rows
from riskspark.catalog import all_queries, modelling
from riskspark.config import ModelConfig
from riskspark.operators import split as P, train as L, trees
from riskspark.sources import testdata as D


def test_scoring_one_file_uses_more_than_one_task(spark, sf):
    table = D.transactions(spark, sf).coalesce(1)
    model = L.fit(table, "txn_id", model=ModelConfig(trees=2, depth=2))
    setting = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(setting, "1k")
    try:
        scored = L.score(table, model, keep=["txn_id"])
        assert scored.rdd.getNumPartitions() > 1
        assert sorted(rows(scored, "txn_id")) == sorted(rows(table, "txn_id"))
    finally:
        spark.conf.unset(setting)


@pytest.mark.parametrize("name", ["gbt_train_score", "model_round_trip", "same_holdout"])
def test_a_query_that_fits_and_scores_splits_once(spark, sf, monkeypatch, name):
    calls, split = [], P.train_test
    monkeypatch.setattr(P, "train_test", lambda *a, **b: calls.append(a) or split(*a, **b))
    monkeypatch.setattr(modelling, "ModelConfig", lambda: ModelConfig(trees=2, depth=2))
    monkeypatch.setattr(modelling, "_saved", {})
    all_queries()[name](spark, sf)
    assert len(calls) == 1


def test_a_tree_is_handed_on_before_the_next_one_grows(spark):
    x = spark.createDataFrame([([float(i)], float(i > 3), 1.0, i) for i in range(8)], "x array<double>, y double, w double, row long")
    grown = trees.grow(x, 8, trees.cut_points(x, 1), [[0]] * 50, 2, 0.1, 1.0, 1, 4.0)
    first = next(grown)
    assert first.feature[1] == 0
    grown.close()
