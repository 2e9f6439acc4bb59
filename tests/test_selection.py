import pytest
from pyspark.sql import functions as F

from conftest import rows
from riskspark.config import PromotionCriteria
from riskspark.operators import metrics as M, selection as S

METRIC_DDL = ("experiment string, precision double, recall double, f1_score double, roc_auc double, "
              "pr_auc double, tn long, fp long, fn long, tp long")
EXPERIMENTS = [
    ("experiment_a", .05, .99, .09, .999, .95, 100000, 5000, 2, 198),
    ("experiment_b", .60, .96, .74, .998, .97, 104800, 200, 8, 192),
    ("experiment_c", .90, .80, .85, .990, .92, 104980, 20, 40, 160),
]
# published counts at thresholds .5 to .9: tp, tn, fp, fn
PUBLISHED = [(.5, 2455, 1905953, 369, 9), (.6, 2455, 1905984, 338, 9), (.7, 2455, 1906016, 306, 9),
             (.8, 2455, 1906060, 262, 9), (.9, 2454, 1906079, 243, 10)]


def pick(spark, table, **kw):
    return S.best_experiment(spark.createDataFrame(table, METRIC_DDL), **kw).first().experiment


def test_best_experiment_needs_recall(spark):
    assert pick(spark, EXPERIMENTS, min_recall=.95) == "experiment_b"


def test_fallback_uses_the_same_order_on_all(spark):
    table = [("x", .5, .70, .5, .9, .90, 1, 1, 1, 1), ("y", .5, .85, .5, .9, .88, 1, 1, 1, 1)]
    assert pick(spark, table, min_recall=.99) == "x"


def test_ties_go_to_fewer_misses_then_f1(spark):
    table = [("x", .5, .99, .5, .9, .9, 1, 1, 5, 1), ("y", .5, .99, .5, .9, .9, 1, 1, 3, 1),
             ("z", .5, .99, .9, .9, .9, 1, 1, None, 1)]
    assert pick(spark, table) == "y"


def grid(spark, values):
    return spark.createDataFrame(
        [(i, t, r, f) for i, (t, r, f) in enumerate(values)], "position int, threshold double, recall double, f1_score double")


def test_best_threshold(spark):
    assert S.best_threshold(grid(spark, [(.5, .99, .10), (.7, .95, .60), (.9, .80, .85)]), .90).first().threshold == .7
    assert S.best_threshold(grid(spark, [(.5, .90, .30), (.7, .85, .50)]), .99).first().threshold == .5
    assert S.best_threshold(grid(spark, [(.8, .99, .5), (.6, .99, .5)]), .9).first().threshold == .8


def test_grid_keeps_the_given_order_and_repeats(spark):
    scored = spark.createDataFrame(
        [(0, .1), (0, .4), (1, .8), (1, .6), (1, .9), (0, .2), (1, .55), (0, .35)], "y int, p double")
    found = S.threshold_grid(scored, [.7, .3, .5, .3]).orderBy("position").collect()
    assert [r.threshold for r in found] == [.7, .3, .5, .3]
    assert [(r.tp, r.fp, r.fn, r.tn) for r in found] == [(2, 0, 2, 4), (4, 2, 0, 2), (4, 0, 0, 4), (4, 2, 0, 2)]
    default = S.threshold_grid(scored, []).orderBy("position").collect()
    assert [r.threshold for r in default] == [.5, .6, .7, .8, .9]
    assert all(a.recall >= b.recall for a, b in zip(default, default[1:]))


def test_published_grid_gives_the_published_choice(spark):
    counts = spark.createDataFrame(
        [(i, t, tp, tn, fp, fn) for i, (t, tp, tn, fp, fn) in enumerate(PUBLISHED)],
        "position int, threshold double, tp long, tn long, fp long, fn long")
    scored = M.with_prf(counts)
    f1 = [r.f1_score for r in scored.orderBy("position").collect()]
    assert f1 == pytest.approx([0.9285173978819969, 0.933992771542705, 0.939712918660287, 0.9476934954641961, 0.9509784925402054])
    assert S.best_threshold(scored, .95).first().threshold == .9


def test_published_experiments_give_the_published_choice(spark):
    table = [
        ("baseline_smote_scale_weight", .0318, .99878, .0617, .99978, 0.9866473365867116, 1831428, 74894, 3, 2461),
        ("smote_only", .794, .99797, .8844, .99974, 0.9886744289382876, 1905684, 638, 5, 2459),
        ("scale_weight_only", .8693, .99635, .9285, .99969, 0.9889046357235814, 1905953, 369, 9, 2455),
    ]
    assert pick(spark, table) == "scale_weight_only"


CHAMPION = ("champion", .8, .9, .85, .95, .8, 0, 0, 10, 0)


def gate(spark, pr_auc, recall, f1, fn, criteria=PromotionCriteria(), precision=.9):
    table = [("candidate", precision, recall, f1, .95, pr_auc, 0, 0, fn, 0), CHAMPION]
    metrics = spark.createDataFrame(table, METRIC_DDL).withColumns({"test_samples": F.lit(100), "invalid_scores": F.lit(0)})
    return S.promotion_gate(S.metric_deltas(metrics), criteria).first()


@pytest.mark.parametrize("values, decision, failed", [
    ((.85, .92, .88, 8), "PROMOTE", []),
    ((.7, .8, .75, 20), "REJECT", ["recall", "pr_auc", "f1_score", "false_negatives"]),
    ((.85, .89, .90, 11), "REJECT", ["recall", "false_negatives"]),
    ((.79, .91, .86, 9), "REJECT", ["pr_auc"]),
    ((.8, .9, .85, 10), "REJECT", ["f1_score"]),
])
def test_promotion_gate(spark, values, decision, failed):
    found = gate(spark, *values)
    assert (found.decision, found.failed_criteria) == (decision, failed)
    assert found.approval_state == ("PENDING_APPROVAL" if decision == "PROMOTE" else "REJECTED")


def test_equal_f1_passes_without_a_minimum(spark):
    assert gate(spark, .8, .9, .85, 10, PromotionCriteria(min_f1_delta=0.0)).decision == "PROMOTE"


def test_nan_metrics_never_promote(spark):
    found = gate(spark, float("nan"), .92, .88, 8)
    assert found.failed_criteria == ["pr_auc", "candidate_metrics_valid"]
    assert gate(spark, .85, .92, .88, 8, precision=float("nan")).failed_criteria == ["candidate_metrics_valid"]


def test_comparison_report_and_metadata(spark):
    scored = spark.createDataFrame(
        [(e, i % 2, ((i * 7) % 10) / 10 if e == "a" else (i % 2) * .95) for e in "ab" for i in range(40)],
        "experiment string, y int, p double")
    metrics = M.metric_bundle(scored, 0.5)
    report = S.comparison_report(metrics, scored).orderBy("experiment").collect()
    assert [r.is_selected for r in report] == [False, True]
    assert len(report[0].threshold_analysis) == 5
    grid_best = S.best_threshold(S.threshold_grid(scored, by=["experiment"]), by=["experiment"])
    configs = spark.createDataFrame([("a", True, False), ("b", False, True)], "experiment string, use_smote boolean, use_class_weight boolean")
    found = S.model_metadata(metrics, grid_best, configs, "detector")
    assert {(r.model, r.experiment, r.use_smote) for r in found.collect()} == {("detector", "b", False)}
    assert found.where("selected AND metric = 'recall'").first().value == 1.0
    assert found.where("NOT selected").count() == 5


def test_a_model_with_nan_scores_is_never_promoted(spark):
    frauds = [("champion", 1, .95)] * 9 + [("champion", 1, .1)] + [("candidate", 1, .95)] * 5 + [("candidate", 1, float("nan"))] * 5
    others = [(m, 0, .1) for m in ("champion", "candidate") for _ in range(20)]
    scored = spark.createDataFrame(frauds + others, "experiment string, y int, p double")
    metrics = M.metric_bundle(scored, 0.9)
    found = S.promotion_gate(S.metric_deltas(metrics)).first()
    assert found.decision == "REJECT" and "scores_valid" in found.failed_criteria
    assert (found.candidate_test_samples, found.candidate_invalid_scores, found.champion_invalid_scores) == (30, 5, 0)
    # bundle, counts and grid agree on the rows
    counts = {r.experiment: r for r in M.confusion(scored, 0.9, by=["experiment"]).collect()}
    grid = {r.experiment: r for r in S.threshold_grid(scored, [0.9], by=["experiment"]).collect()}
    for r in metrics.collect():
        for other in (counts[r.experiment], grid[r.experiment]):
            assert [getattr(r, c) for c in (*M.COUNTS, "invalid_scores")] == [getattr(other, c) for c in (*M.COUNTS, "invalid_scores")]
        assert r.test_samples == sum(getattr(r, c) for c in (*M.COUNTS, "invalid_scores"))


def test_other_rows_are_no_comparison(spark):
    scored = spark.createDataFrame([("champion", i % 2, .9 * (i % 2)) for i in range(10)] + [("candidate", 1, .95), ("candidate", 0, .1)],
                                   "experiment string, y int, p double")
    found = S.promotion_gate(S.metric_deltas(M.metric_bundle(scored, 0.5))).first()
    assert "same_rows" in found.failed_criteria
