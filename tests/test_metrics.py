import pytest
from pyspark.sql import functions as F

from conftest import rows
from riskspark.operators import metrics as M

SCORES = [(0, .1), (0, .4), (1, .8), (1, .6), (1, .9), (0, .2), (1, .55), (0, .35)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(SCORES, "y int, p double").persist()


def brute_auc(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total, out, before = sum(y for y, _ in pairs), 0.0, 0.0
    for t in sorted({p for _, p in pairs}, reverse=True):
        hits = [y for y, p in pairs if p >= t]
        recall = sum(hits) / total
        out += (recall - before) * sum(hits) / len(hits)
        before = recall
    return out


def test_perfect_ranking(scored):
    assert M.roc_auc(scored).first().roc_auc == 1.0
    assert M.average_precision(scored).first().pr_auc == pytest.approx(1.0)


def test_tied_scores(spark):
    tied = spark.createDataFrame([(y, .8) for y in (0, 1, 0, 1)], "y int, p double")
    found = M.metric_bundle(tied, 0.5, by=[]).first()
    assert (found.roc_auc, found.pr_auc, found.tp, found.fp, found.test_samples) == (0.5, 0.5, 2, 2, 4)


@pytest.mark.parametrize("buckets", [1, 5])
def test_against_brute_force(spark, buckets):
    pairs = [((i * 7) % 5 == 0, ((i * 37) % 23) / 23) for i in range(120)]
    pairs = [(int(y), p) for y, p in pairs]
    table = spark.createDataFrame(pairs, "y int, p double")
    found = M.metric_bundle(table, 0.5, by=[], buckets=buckets).first()
    assert found.roc_auc == pytest.approx(brute_auc(pairs))
    assert found.pr_auc == pytest.approx(brute_ap(pairs))


def test_auc_ignores_monotone_transforms(scored):
    warped = scored.withColumn("p", F.pow("p", F.lit(3.0)))
    assert rows(M.roc_auc(warped)) == rows(M.roc_auc(scored))


def test_confusion_uses_at_or_above(spark):
    table = spark.createDataFrame([(0, 0.), (0, .1), (1, .9), (1, 1.), (1, float("nan"))], "y int, p double")
    found = M.with_prf(M.confusion(table.where(~F.isnan("p")), 0.9)).first()
    assert (found.tn, found.fp, found.fn, found.tp, found.precision, found.recall) == (2, 0, 0, 2, 1.0, 1.0)
    assert tuple(M.confusion(table, 0.9).first()) == (2, 0, 0, 2, 1)


def test_zero_denominators(spark):
    none = spark.createDataFrame([(0, .1), (0, .2)], "y int, p double")
    found = M.with_prf(M.confusion(none, 0.5)).first()
    assert (found.precision, found.recall, found.f1_score) == (0.0, 0.0, 0.0)
    assert M.roc_auc(none).first().roc_auc is None


def test_curves(scored):
    roc = rows(M.roc_curve(scored).orderBy(F.desc_nulls_first("threshold")))
    assert roc[0] == (None, 0.0, 0.0) and roc[-1] == (.1, 1.0, 1.0) and len(roc) == 9
    pr = rows(M.pr_curve(scored).orderBy(F.asc_nulls_last("threshold")))
    assert pr[0] == (.1, .5, 1.0) and pr[-1] == (None, 1.0, 0.0)
    assert 1 <= M.thin_curve(M.roc_curve(scored).where("threshold IS NOT NULL"), 3).count() <= 4


def test_best_f1_takes_the_lowest_of_equal_thresholds(scored):
    assert M.best_f1_threshold(scored).first().threshold == .55
    flat = scored.sparkSession.createDataFrame([(1, .2), (1, .4)], "y int, p double")
    assert M.best_f1_threshold(flat).first().threshold == .2


def test_published_classification_report(spark):
    counts = {(0, 0.0): 1905953, (0, 1.0): 369, (1, 0.0): 9, (1, 1.0): 2455}
    # weighted rows: expand the published counts with a range instead of literal rows
    parts = [spark.range(n).select(F.lit(y).alias("y"), F.lit(p).alias("p")) for (y, p), n in counts.items()]
    table = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    found = {r.label: r for r in M.classification_report(table, 0.5).collect()}
    assert found["accuracy"].precision == pytest.approx(0.9998019683715199)
    assert found["macro avg"].f1_score == pytest.approx(0.964209122361709)
    assert found["weighted avg"].f1_score == pytest.approx(0.9998086998861121)
    assert found["1"].precision == pytest.approx(0.8693342776203966)
    assert (found["0"].support, found["1"].support) == (1906322, 2464)
