import glob
import shutil

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskspark.config import ModelConfig
from riskspark.operators import train as L, trees as R

WHOLE = ModelConfig(trees=1, depth=2, learning_rate=1.0, row_subsample=1.0, column_subsample=1.0)


def table(spark, x, y, w=None):
    data = [(list(map(float, a)), int(b), float(c)) for a, b, c in zip(x, y, w if w is not None else np.ones(len(y)))]
    return spark.createDataFrame(data, "a array<double>, isFraud int, weight double").select(
        array_to_vector("a").alias("features"), "isFraud", "weight")


def best_split(x, step, w):
    """The split of lowest weighted sum of squares, over every bound of every column."""
    def squares(part):
        return (w[part] * (step[part] - np.average(step[part], weights=w[part])) ** 2).sum() if part.any() else 0.0

    return min(((squares(x[:, c] <= t) + squares(x[:, c] > t), c, t) for c in range(x.shape[1]) for t in np.unique(x[:, c])[:-1]))


def test_a_level_is_one_job(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 40, (300, 3))
    rows = table(spark, x, x[:, 0] * x[:, 1] % 3 == 0).persist()
    rows.count()
    jobs = []
    for trees in (2, 12):
        group = f"trees-{trees}"
        spark.sparkContext.setJobGroup(group, group)
        L.boost(rows, config=ModelConfig(trees=trees, depth=4))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rows.unpersist()
    assert jobs[1] - jobs[0] <= 10 * 4


def test_splits_are_the_best_over_all_rows(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 30, (400, 4))
    y = (x[:, 2] + rng.integers(0, 15, 400) > 25) | (x[:, 0] == 3)
    w = 1.0 + y * 3
    model, _ = L.boost(table(spark, x, y, w).repartition(7), config=WHOLE)
    root = model.trees[0]._call_java("rootNode")
    step, curve = (y - .5) / .25, w * .25
    part = np.ones(400, bool)
    for node, side in ((root, part), (root.leftChild(), None), (root.rightChild(), None)):
        if side is None:
            below = x[:, root.split().featureIndex()] <= root.split().threshold()
            side = below if node.equals(root.leftChild()) else ~below
        want, column, bound = best_split(x[side], step[side], curve[side])
        at = x[side][:, node.split().featureIndex()] <= node.split().threshold()
        got = sum((curve[side][s] * (step[side][s] - np.average(step[side][s], weights=curve[side][s])) ** 2).sum() for s in (at, ~at))
        assert got == pytest.approx(want)
        assert node.prediction() == pytest.approx(np.average(step[side], weights=curve[side]))
        assert node.impurityStats().rawCount() == side.sum()
        assert node.impurityStats().count() == pytest.approx(curve[side].sum())
        assert node.impurity() == pytest.approx(np.average((step[side] - node.prediction()) ** 2, weights=curve[side]))


def test_bounds_lie_between_all_values_of_a_short_column_and_between_quantiles_of_a_long_one(spark):
    n = 20_000
    rows = spark.range(n).select(F.array(
        F.when(F.col("id") == 17, 5.0).when(F.col("id") < 9_000, -1.0).otherwise(9.0),  # 5.0 is rare and in the middle
        F.col("id").cast("double"), F.lit(2.0)).alias("x"))
    short, long, constant = R.cut_points(rows, 3)
    assert list(short) == [2.0, 7.0] and len(constant) == 0
    assert len(long) <= R.BINS - 1
    sizes = np.diff(np.concatenate([[0], np.searchsorted(np.arange(n), long, side="right"), [n]]))
    assert sizes.max() <= n / (R.BINS - 1) * 1.3 and sizes.min() > 0


@pytest.mark.parametrize("values", [[float("nan"), 1.0], [float("inf"), 1.0]])
def test_values_that_are_no_numbers_are_refused(spark, values):
    with pytest.raises(Exception, match="must not be null, NaN or infinite"):
        L.boost(table(spark, [[v] for v in values], [0, 1]), config=WHOLE)


def test_many_tasks_and_checkpoints_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 200, (600, 3))
    rows = table(spark, x, x[:, 0] > x[:, 1]).coalesce(1).persist()
    config = ModelConfig(trees=7, depth=3, learning_rate=0.3)

    def scores():
        model, _ = L.boost(rows, config=config)
        found = model.transform(rows).select("features", vector_to_array("probability")[1].alias("p")).collect()
        return {tuple(r.features): r.p for r in found}

    one = scores()
    for name, value in (("TASK_ROWS", 50), ("DRIVER_BYTES", 0), ("KEPT_EVERY", 2)):
        monkeypatch.setattr(R, name, value)
    other = scores()
    rows.unpersist()
    assert one.keys() == other.keys() and all(one[k] == pytest.approx(other[k]) for k in one)


def test_what_is_left_of_a_parent_is_what_summing_it_up_gives(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 100, (3000, 6))
    rows = table(spark, x, x[:, 0] * x[:, 1] % 7 == 0, 1.0 + rng.integers(0, 50, 3000)).persist()
    config = ModelConfig(trees=6, depth=5, learning_rate=0.4)
    asked, added = [], R._added

    def told(held, layout, step):
        asked.append(len(step.nodes))
        return added(held, layout, step)

    monkeypatch.setattr(R, "_added", told)
    found = []
    for least in (R.LEAST_LEFT, float("inf")):  # infinity: every node is summed up
        monkeypatch.setattr(R, "LEAST_LEFT", least)
        model, _ = L.boost(rows, config=config)
        found.append([r.p for r in model.transform(rows).select(vector_to_array("probability")[1].alias("p")).collect()])
    rows.unpersist()
    half = len(asked) // 2
    assert sum(asked[:half]) < 0.7 * sum(asked[half:])
    # rounding decides between splits of one gain
    assert np.mean(np.abs(np.subtract(*found)) > 1e-9) < 0.01


def test_rows_that_are_lost_are_made_again(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 50, (800, 3))
    rows = table(spark, x, x[:, 0] > x[:, 2]).persist()
    config = ModelConfig(trees=9, depth=3, learning_rate=0.3)

    def scores():
        model, _ = L.boost(rows, config=config)
        return [r.p for r in model.transform(rows).select(vector_to_array("probability")[1].alias("p")).collect()]

    want, added, steps = scores(), R._added, []

    def losing(held, layout, step):
        steps.append((step.turn, step.level))
        if len(steps) in (2, 14, 20):
            held.foreach(lambda folder: shutil.rmtree(folder))
        return added(held, layout, step)

    monkeypatch.setattr(R, "_added", losing)
    monkeypatch.setattr(R, "KEPT_EVERY", 2)
    monkeypatch.setattr(R.time, "sleep", lambda seconds: None)
    got = scores()
    rows.unpersist()
    assert len(steps) > len(set(steps)) and got == pytest.approx(want, abs=1e-12)


def test_no_files_are_left(spark):
    folders = f"{spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]}/boosting-*"
    x = np.arange(200).reshape(100, 2)
    L.boost(table(spark, x, x[:, 0] > 90), config=ModelConfig(trees=2, depth=2))
    assert not glob.glob(folders)
