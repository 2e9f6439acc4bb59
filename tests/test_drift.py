import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.config import NUMERIC_FEATURES, DriftConfig
from riskspark.errors import DriftDataError
from riskspark.operators import drift as R

TYPES = ["CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER"]


def table(spark, shifted=False, n=100):
    rows = []
    for i in range(n):
        amount = (10000.0 if shifted else 100.0) + i
        old, dest = 1000.0 + i, 50.0 + i
        rows.append(("TRANSFER" if shifted else TYPES[i % 5], amount, old, old - 100, dest, dest + 100, 100.0, 100.0, amount / (old + 1)))
    return spark.createDataFrame(rows, "type string, " + ", ".join(f"{c} double" for c in NUMERIC_FEATURES))


@pytest.mark.parametrize("method", ["distance", "p_value"])
def test_shift_is_found(spark, method):
    per_feature, summary = R.compare(table(spark), table(spark, True), method=method)
    drifted = {r.feature for r in per_feature.where("drift_detected").collect()}
    assert {"amount", "type"} <= drifted
    assert not drifted & {"oldbalanceOrg", "balance_diff_orig"}
    found = summary.first()
    assert found.drift_share > 0 and found.investigation_required
    assert (found.reference_rows, found.current_rows) == (100, 100)


@pytest.mark.parametrize("method", ["distance", "p_value"])
def test_identical_tables_do_not_drift(spark, method):
    per_feature, summary = R.compare(table(spark), table(spark), method=method)
    found = summary.first()
    assert (found.drifted, found.drift_share, found.dataset_drift_detected, found.investigation_required) == (0, 0.0, False, False)
    scores = {r.drift_score for r in per_feature.collect()}
    assert scores == ({0.0} if method == "distance" else {1.0})


def test_bad_input_is_an_error(spark):
    good = table(spark)
    for bad in (good.drop("amount"), good.withColumn("amount", F.lit(float("inf"))), good.where("1 = 0")):
        with pytest.raises(DriftDataError):
            R.compare(good, bad)
    with pytest.raises(ValueError):
        DriftConfig(share_threshold=0.0)
    with pytest.raises(ValueError):
        R.feature_drift(good, good, method="other")


def test_row_count_does_not_choose_the_method(spark):
    small = table(spark).limit(20)
    for reference in (small, small.crossJoin(spark.range(60)).drop("id")):
        assert {r.method for r in R.compare(reference, small)[0].collect()} == {"normed_wasserstein", "jensen_shannon"}


# published quantiles and exact closed forms
@pytest.mark.parametrize(("x", "df", "want"), [
    (9.487729036781154, 4, 0.05), (11.070497693516351, 5, 0.05), (3000.0, 1000, 0.0), (3000.0, 1001, 0.0), (1e6, 149, 0.0),
    (1e6, 10_000, 0.0), (2.0, 2, 0.36787944117144233), (0.0, 7, 1.0), (10.0, 1, 0.0015654022580025495), (1000.0, 1000, 0.4940),
    (1001.0, 1001, 0.4940), (10_000.0, 10_000, 0.4981), (1.0, 1000, 1.0), (float("inf"), 3, 0.0)])
def test_chi_square_tail(x, df, want):
    assert R.chi_square_upper_tail(x, df) == pytest.approx(want, abs=1e-4 if want > 0.4 else 1e-9)


def test_scores_that_are_none_are_reported(spark):
    good = spark.createDataFrame([(0.1,)] * 8 + [(0.95,)] * 2, "p double")
    bad = good.unionByName(spark.createDataFrame([(float("nan"),), (1.5,), (None,), (-0.1,), (float("inf"),)], "p double"))
    for r in R.score_drift(good, bad, "p", 0.9).collect():
        assert (r.drift_score, r.reference_invalid_scores, r.current_invalid_scores) == (0.0, 0, 5)


@pytest.mark.parametrize("buckets", [1, 6])
def test_distances_against_numpy(spark, buckets, monkeypatch):
    monkeypatch.setattr(R, "SKETCH_SHARE", 1.0)
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=300).round(1), rng.normal(0.4, 1.3, size=200).round(1)
    found = R.numeric_distances(
        spark.createDataFrame([(float(x),) for x in a], "v double"),
        spark.createDataFrame([(float(x),) for x in b], "v double"), ["v"], buckets).first()
    points = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    assert found.ks == pytest.approx(np.abs(fa - fb).max())
    assert found.wasserstein == pytest.approx((np.abs(fa - fb)[:-1] * np.diff(points)).sum())
    assert found.normed_wasserstein == pytest.approx(found.wasserstein / a.std())


def test_jensen_shannon_of_disjoint_categories(spark):
    a = spark.createDataFrame([("x",)] * 3, "c string")
    b = spark.createDataFrame([("y",)] * 4, "c string")
    assert R.categorical_distances(a, b, ["c"]).first().jensen_shannon == pytest.approx(math.sqrt(math.log(2)))
    assert R.categorical_distances(a, b, ["c"], log_base=2).first().jensen_shannon == pytest.approx(1.0)


@pytest.mark.parametrize("x, df, p", [
    # published upper critical values of the chi-square distribution
    (3.841, 1, .05), (6.635, 1, .01), (5.991, 2, .05), (7.815, 3, .05), (9.488, 4, .05), (11.070, 5, .05),
    (18.307, 10, .05), (24.996, 15, .05), (0.0, 4, 1.0),
])
def test_chi_square_tail(x, df, p):
    assert R.chi_square_upper_tail(x, df) == pytest.approx(p, abs=2e-4)


def test_ks_p_value_at_published_points(spark):
    # asymptotic critical values of sqrt(nm / (n + m)) D: 1.358 at 5 %, 1.628 at 1 %
    df = spark.createDataFrame([(1.358, .05), (1.628, .01), (0.0, 1.0)], "x double, p double")
    n = F.lit(200)
    found = df.select(R.ks_p_value(F.col("x") / F.sqrt(F.lit(100.0)), n, n).alias("got"), "p").collect()
    assert all(r.got == pytest.approx(r.p, abs=3e-4) for r in found)


def test_score_drift(spark):
    ref = spark.range(1000).selectExpr("id / 1000D AS p")
    cur = spark.range(1000).selectExpr("0.5 + id / 2000D AS p")
    found = {r.feature: r for r in R.score_drift(ref, cur, "p", 0.9).collect()}
    assert found["probability"].drift_detected
    # decisions are (.9, .1) against (.8, .2)
    m, n = .85, .15
    js = math.sqrt((.9 * math.log(.9 / m) + .1 * math.log(.1 / n) + .8 * math.log(.8 / m) + .2 * math.log(.2 / n)) / 2)
    assert found["decision"].drift_score == pytest.approx(js)


# --- the kept index ------------------------------------------------------------------------

def index_pair(spark, rng, n, m):
    ref = [(float(a), float(b), f"c{k}") for a, b, k in zip(rng.normal(size=n).round(2), rng.exponential(50, n).round(1), rng.integers(0, 5, n))]
    cur = [(float(a), float(b), f"c{k}") for a, b, k in zip(rng.normal(0.3, 2, m).round(2), rng.exponential(40, m).round(1), rng.integers(1, 7, m))]
    ddl = "v double, w double, c string"
    return spark.createDataFrame(ref, ddl), spark.createDataFrame(cur, ddl)


@pytest.mark.parametrize("m", [1, 3, 400])
def test_index_gives_the_same_distances(spark, tmp_path, m):
    from riskspark.operators.drift_index import build_index, category_distances, compared

    ref, cur = index_pair(spark, np.random.default_rng(m), 500, m)
    index = build_index(ref, str(tmp_path / "index"), ["v", "w"], ["c"], cells=20)
    assert len(index.points) > 10
    names = ["feature", "reference_rows", "current_rows", "wasserstein", "ks", "std", "normed_wasserstein"]
    found = compared(index, cur)
    want = {r[0]: r[1:] for r in R.numeric_distances(ref, cur, ["v", "w"]).select(names).collect()}
    got = {r[0]: r[1:] for r in found.distances.select(names).collect()}
    assert got.keys() == want.keys()
    for f in want:
        assert got[f] == pytest.approx(want[f])
    want = R.categorical_distances(ref, cur, ["c"]).first().asDict()
    assert category_distances(index, cur, math.e).first().asDict() == pytest.approx(want)
    if m < 10:  # touched cells, and one crossed between any two
        assert len(found.cells) <= 2 * (2 * m + 1)


def test_values_on_and_beyond_the_cut_points(spark, tmp_path):
    from riskspark.operators.drift_index import build_index, compared

    ref = spark.createDataFrame([(float(x),) for x in range(100)], "v double")
    index = build_index(ref, str(tmp_path / "index"), ["v"], [], cells=10)
    for values in ([-50.0], [*index.points, 500.0], [50.5] * 3):
        cur = spark.createDataFrame([(float(x),) for x in values], "v double")
        want, got = (d.first() for d in (R.numeric_distances(ref, cur, ["v"]), compared(index, cur).distances))
        assert (got.wasserstein, got.ks) == pytest.approx((want.wasserstein, want.ks)), values


def test_a_comparison_reads_only_touched_cells(spark, tmp_path):
    import shutil

    from riskspark.operators.drift_index import build_index, compared, open_index

    spark.range(5000).selectExpr("CAST(id AS DOUBLE) AS v", "'x' AS c").write.parquet(str(tmp_path / "reference"))
    ref = spark.read.parquet(str(tmp_path / "reference"))
    index = build_index(ref, str(tmp_path / "index"), ["v"], ["c"], cells=50)
    shutil.move(tmp_path / "reference", tmp_path / "gone")  # nothing may read it again
    cur = spark.createDataFrame([(100.5, "x"), (101.5, "x")], "v double, c string")
    again = build_index(ref, str(tmp_path / "index"), ["v"], ["c"])
    assert again.points == index.points == open_index(spark, str(tmp_path / "index")).points
    found = compared(index, cur)
    assert found.distances.first().reference_rows == 5000 and 1 <= len(found.cells) <= 3
    scan = found.distances._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell#", scan)
    with pytest.raises(FileNotFoundError):
        open_index(spark, str(tmp_path / "none"))
