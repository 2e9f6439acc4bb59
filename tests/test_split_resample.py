import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from riskspark.config import SmoteConfig, SplitConfig
from riskspark.operators import resample as S, split as P
from riskspark.operators.neighbours import nearest_neighbours


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(100).selectExpr("id", "CAST(id % 4 = 0 AS INT) AS isFraud").persist()


def quotas(spark, totals, share):
    return dict(rows(P.test_quotas(spark.createDataFrame(list(totals.items()), "cls int, n long"), share), "cls", "want"))


def test_sizes_follow_the_shares(spark):
    assert quotas(spark, {0: 6354407, 1: 8213}, 0.3) == {0: 1906322, 1: 2464}
    assert quotas(spark, {0: 20, 1: 20}, 0.25) == {0: 5, 1: 5}
    sizes = quotas(spark, {0: 75, 1: 25}, 0.3)
    assert sum(sizes.values()) == 30 and sizes[1] in (7, 8)


def test_split_of_very_many_classes(spark):
    """Every class has its quota by largest remainder, and no list of classes reaches the driver."""
    table = spark.range(50_000).selectExpr("id", "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('c', id % 9000) END AS c")
    marked = P.assign_split(table, "id", "c").persist()
    sizes = {r.c: (r.n, r.t) for r in marked.groupBy("c").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect()}
    wanted = math.ceil(0.3 * 50_000)
    exact = {c: wanted * n / 50_000 for c, (n, _) in sizes.items()}
    low = {c: math.floor(x) for c, x in exact.items()}
    order = sorted(exact, key=lambda c: (-(exact[c] - low[c]), "" if c is None else c))
    for c in order[: wanted - sum(low.values())]:
        low[c] += 1
    assert {c: t for c, (_, t) in sizes.items()} == low


def test_split_is_exact_disjoint_and_covering(labelled):
    train, test = P.train_test(labelled, "id")
    assert (train.count(), test.count()) == (70, 30)
    assert train.where("isFraud = 1").count() in (17, 18)
    assert train.join(test, "id").count() == 0
    same = P.train_test(labelled.repartition(9), "id")[1]
    assert sorted(rows(same, "id")) == sorted(rows(test, "id"))
    other = P.train_test(labelled, "id", config=SplitConfig(seed=7))[1]
    assert sorted(rows(other, "id")) != sorted(rows(test, "id"))


def test_quarter_split_of_forty(spark):
    table = spark.range(40).selectExpr("id", "CAST(id % 2 AS INT) AS isFraud")
    _, test = P.train_test(table, "id", config=SplitConfig(test_size=0.25))
    assert dict(rows(test.groupBy("isFraud").count())) == {0: 5, 1: 5}


def test_split_without_strata(labelled):
    _, test = P.train_test(labelled, "id", config=SplitConfig(stratify=False))
    assert test.count() == 30


def test_split_does_not_shuffle_the_table(labelled):
    marked = P.assign_split(labelled, "id")
    assert "hashpartitioning" not in marked._jdf.queryExecution().executedPlan().toString()


def test_class_weights(labelled):
    assert P.class_weight_table(labelled).first().positive_weight == 3.0
    assert P.class_weight_table(labelled, enabled=False).first().positive_weight == 1.0
    assert P.class_weight_table(labelled.where("isFraud = 0")).first().positive_weight == 1.0
    weights = dict(rows(P.with_class_weight(labelled).select("isFraud", "weight").distinct()))
    assert weights == {0: 1.0, 1: 3.0}


def brute(points, k):
    out = {}
    for i, v in points.items():
        d = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in points.items() if j != i)
        out[i] = [j for _, j in d[:k]]
    return out


@pytest.mark.parametrize("block_rows", [8, 64, 10_000])
@pytest.mark.parametrize("kind", ["spread", "skewed", "copies"])
def test_neighbours_equal_brute_force(spark, block_rows, kind):
    rng = np.random.default_rng(3)
    n = 240
    x = rng.normal(size=(n, 3)).round(3)
    if kind == "skewed":
        x[: n // 3] = x[0] + rng.normal(scale=1e-3, size=(n // 3, 3)).round(6)
        x[-3:] *= 1000
    if kind == "copies":
        x[: n // 3] = x[0]
    points = {i: tuple(map(float, v)) for i, v in enumerate(x)}
    df = spark.createDataFrame([(i, list(v)) for i, v in points.items()], "id long, v array<double>")
    found = {}
    for r in nearest_neighbours(df, "id", F.col("v"), 4, block_rows=block_rows).orderBy("id", "rank").collect():
        found.setdefault(r.id, []).append(r.neighbour)
    assert found == brute(points, 4)


def test_a_vector_with_very_many_copies_is_joined_in_parts(spark, monkeypatch):
    from riskspark.operators import neighbours as N

    monkeypatch.setattr(N, "COPIES_PER_PART", 10)
    points = {i: (0.0, 0.0) if i % 3 else (float(i), 1.0) for i in range(90)}
    df = spark.createDataFrame([(i, list(v)) for i, v in points.items()], "id long, v array<double>")
    found = {}
    for r in N.nearest_neighbours(df, "id", F.col("v"), 4, block_rows=16).orderBy("id", "rank").collect():
        found.setdefault(r.id, []).append(r.neighbour)
    assert found == brute(points, 4)


def test_neighbours_of_tiny_tables(spark):
    two = spark.createDataFrame([(1, [0.0]), (2, [3.0])], "id long, v array<double>")
    assert rows(nearest_neighbours(two, "id", F.col("v"), 5).select("id", "neighbour", "rank", "distance").orderBy("id")) == [
        (1, 2, 1, 3.0), (2, 1, 1, 3.0)]
    assert rows(nearest_neighbours(two.where("id = 9"), "id", F.col("v"), 5)) == []


def test_synthetic_points_lie_between_minority_neighbours(spark):
    table = spark.range(200).selectExpr(
        "id", "CAST(id % 20 = 0 AS INT) AS isFraud", "array(CAST(id % 13 AS DOUBLE), CAST(id % 7 AS DOUBLE)) AS features")
    made = S.smote(table, "id", "features", config=SmoteConfig(k=3))
    found = made.collect()
    assert len(found) == 190 - 10
    minority = {r.id: r.features for r in table.where("isFraud = 1").collect()}
    for r in found:
        assert r.base in minority and r.neighbour in minority and r.base != r.neighbour
        assert 0 <= r.gap < 1 and r.isFraud == 1
        for value, a, b in zip(r.features, minority[r.base], minority[r.neighbour]):
            assert value == pytest.approx(a + r.gap * (b - a))
    per_base = {}
    for r in found:
        per_base[r.base] = per_base.get(r.base, 0) + 1
    assert set(per_base.values()) == {18}
    again = S.smote(table.repartition(7), "id", "features", config=SmoteConfig(k=3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_nothing_to_oversample(spark):
    balanced = spark.createDataFrame([(1, 0, [0.0]), (2, 1, [1.0])], "id long, isFraud int, features array<double>")
    assert S.smote(balanced, "id", "features").count() == 0


def test_rows_that_share_a_key_all_take_part(spark):
    rows_ = [(f"m{i}", 0, [float(i), 0.0]) for i in range(60)] + [("same", 1, [1.0, 2.0])] * 7 + [(f"f{i}", 1, [float(i), 5.0]) for i in range(5)]
    table = spark.createDataFrame(rows_, "id string, isFraud int, features array<double>")
    made = S.smote(table, "id", "features", config=SmoteConfig(k=5))
    assert made.count() == 48
    assert {r["count"] for r in made.groupBy("base").count().collect()} == {4}


def test_too_few_neighbours_are_refused(spark):
    table = spark.createDataFrame([(i, int(i < 3), [float(i)]) for i in range(20)], "id long, isFraud int, features array<double>")
    with pytest.raises(ValueError):
        S.smote(table, "id", "features", config=SmoteConfig(k=5))


def test_very_many_copies_are_unrolled_in_parts(spark, monkeypatch):
    monkeypatch.setattr(S, "PART_COPIES", 7)
    table = spark.createDataFrame([(i, int(i < 4), [float(i)]) for i in range(100)], "id long, isFraud int, features array<double>")
    made = S.smote(table, "id", "features", config=SmoteConfig(k=3))
    assert made.count() == made.select("base", "copy").distinct().count() == 92


def test_a_split_by_very_many_labels(spark):
    labels = spark.range(60_000).selectExpr("id", "IF(id % 20001 = 20000, NULL, CONCAT('c', id % 20001)) AS label")
    marked = P.assign_split(labels, "id", "label")
    assert marked.columns == ["id", "label", "split"] and marked.count() == 60_000
    assert marked.where("split = 'test'").count() == 18_000
    assert marked.where("split = 'test'").groupBy("label").count().agg(F.max("count")).first()[0] == 1


def test_few_blocks_are_visited(spark):
    rng = np.random.default_rng(8)
    data = rng.normal(size=(3000, 3)) + rng.integers(0, 4, (3000, 1)) * 8
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, v array<double>")
    report = {}
    found = nearest_neighbours(df, "id", F.col("v"), 5, block_rows=50, report=report)
    assert report["vectors"] == 3000
    assert (report["first_visits"] + report["later_visits"]) / 3000 <= 3 * 5
    # the searches are written once, not part of the plan
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") <= 2 and "LogicalRDD" not in plan.split("Join")[-1]
    got = {}
    for r in found.where("id < 40").select("id", "neighbour", "rank").collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbour))
    for i in range(40):
        d = ((data - data[i]) ** 2).sum(axis=1)
        assert [n for _, n in sorted(got[i])] == np.argsort(d, kind="stable")[1:6].tolist()
