"""Threshold grids, selection and promotion gates over the scored table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog.metrics import PRF, SPOILT, THRESHOLD, long_scores, spoilt_scores
from riskspark.catalog.shape import rounded
from riskspark.catalog.tables_sql import LONG_SCORES, TABLES, VALID, bundle_views
from riskspark.config import METRICS, THRESHOLD_GRID
from riskspark.operators import metrics as M, selection as S

GRID_VALUES = ", ".join(f"({i}, CAST({t} AS DOUBLE))" for i, t in enumerate(THRESHOLD_GRID))
GRID = f""", g(position, threshold) AS (VALUES {GRID_VALUES}),
counts_at AS (SELECT experiment, CAST(position AS INT) AS position, threshold, count(*) FILTER (WHERE y = 0 AND {VALID} AND p < threshold) AS tn, count(*) FILTER (WHERE y = 0 AND {VALID} AND p >= threshold) AS fp,
  count(*) FILTER (WHERE y = 1 AND {VALID} AND p < threshold) AS fn, count(*) FILTER (WHERE y = 1 AND {VALID} AND p >= threshold) AS tp,
  count(*) FILTER (WHERE NOT {VALID}) AS invalid_scores FROM long_scores CROSS JOIN g GROUP BY experiment, position, threshold),
grid AS (SELECT *, {PRF} FROM counts_at)
"""


def _best(recall: float) -> str:
    return f""", o AS (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY CASE WHEN recall >= {recall} THEN 0 ELSE 1 END,
      CASE WHEN recall >= {recall} THEN f1_score ELSE recall END DESC, position) AS place FROM grid)
    """


GRID_COLUMNS = 'experiment, position, threshold, tn, fp, fn, tp, invalid_scores, "precision", recall, f1_score'
EXPERIMENT_ORDER = "CASE WHEN recall >= {r} THEN 0 ELSE 1 END, pr_auc DESC, fn, f1_score DESC, grp"
DELTAS = ", deltas AS (SELECT " + ", ".join(
    f"""max(CASE WHEN grp = 'candidate' THEN "{m}" END) AS candidate_{m}, max(CASE WHEN grp = 'champion' THEN "{m}" END) AS champion_{m},
    max(CASE WHEN grp = 'candidate' THEN "{m}" END) - max(CASE WHEN grp = 'champion' THEN "{m}" END) AS {m}_delta""" for m in METRICS
) + """, max(CASE WHEN grp = 'candidate' THEN fn END) AS candidate_fn, max(CASE WHEN grp = 'champion' THEN fn END) AS champion_fn,
  max(CASE WHEN grp = 'candidate' THEN test_samples END) AS candidate_test_samples, max(CASE WHEN grp = 'champion' THEN test_samples END) AS champion_test_samples,
  max(CASE WHEN grp = 'candidate' THEN invalid_scores END) AS candidate_invalid_scores, max(CASE WHEN grp = 'champion' THEN invalid_scores END) AS champion_invalid_scores
  FROM bundle)
"""
DELTA_COLUMNS = ", ".join(
    f"round({x}, 6) + 0 AS {x}" for m in METRICS for x in (f"candidate_{m}", f"champion_{m}", f"{m}_delta")
) + ", CAST(candidate_fn AS BIGINT) AS candidate_fn, CAST(champion_fn AS BIGINT) AS champion_fn, " + ", ".join(
    f"CAST({side}_{c} AS BIGINT) AS {side}_{c}" for side in ("candidate", "champion") for c in ("test_samples", "invalid_scores"))


def bundle(s, sf):
    return M.metric_bundle(long_scores(s, sf), THRESHOLD)


def gate(metrics):
    return S.promotion_gate(S.metric_deltas(metrics)).select(
        "decision", "approval_state", F.array_join("failed_criteria", ", ").alias("failed_criteria"), "reason",
        "candidate_invalid_scores", *[f"check_{c}" for c in CHECKS])


CHECKS = ("recall", "pr_auc", "f1_score", "false_negatives", "candidate_metrics_valid", "scores_valid", "same_rows")
GATE = """, k AS (SELECT recall_delta >= 0 AS check_recall, pr_auc_delta >= 0 AS check_pr_auc,
  f1_score_delta >= 0.001 AS check_f1_score, candidate_fn <= champion_fn AS check_false_negatives,
  NOT (isnan(candidate_roc_auc) OR isnan(candidate_pr_auc)) AS check_candidate_metrics_valid,
  candidate_invalid_scores = 0 AND champion_invalid_scores = 0 AS check_scores_valid,
  candidate_test_samples = champion_test_samples AS check_same_rows, CAST(candidate_invalid_scores AS BIGINT) AS candidate_invalid_scores FROM deltas),
t AS (SELECT *, concat_ws(', ', """ + ", ".join(f"CASE WHEN NOT check_{c} THEN '{c}' END" for c in CHECKS) + """) AS failed_criteria FROM k)
SELECT *, CASE WHEN failed_criteria = '' THEN 'PROMOTE' ELSE 'REJECT' END AS decision,
  CASE WHEN failed_criteria = '' THEN 'PENDING_APPROVAL' ELSE 'REJECTED' END AS approval_state,
  CASE WHEN failed_criteria = '' THEN 'candidate holds every gate' ELSE concat('candidate misses: ', failed_criteria) END AS reason FROM t"""


def comparison(s, sf):
    report = S.comparison_report(bundle(s, sf), long_scores(s, sf))
    return rounded(report.select(
        "experiment", "is_selected", "selected_threshold", *METRICS, "tn", "fp", "fn", "tp",
        F.array_join(F.transform("threshold_analysis", lambda g: F.concat_ws(
            "/", g["threshold"].cast("decimal(4,2)").cast("string"), g["tp"], g["tn"], g["fp"], g["fn"])), ";").alias("grid"),
    ))


QUERIES = {
    "threshold_grid": (
        lambda s, sf: rounded(S.threshold_grid(long_scores(s, sf), by=["experiment"])),
        TABLES + LONG_SCORES + GRID + f"SELECT {GRID_COLUMNS} FROM grid",
    ),
    "best_threshold": (
        lambda s, sf: rounded(S.best_threshold(S.threshold_grid(long_scores(s, sf), by=["experiment"]), 0.95, ["experiment"])),
        TABLES + LONG_SCORES + GRID + _best(0.95) + f"SELECT {GRID_COLUMNS} FROM o WHERE place = 1",
    ),
    "best_threshold_low_recall": (
        lambda s, sf: rounded(S.best_threshold(S.threshold_grid(long_scores(s, sf), by=["experiment"]), 0.3, ["experiment"])),
        TABLES + LONG_SCORES + GRID + _best(0.3) + f"SELECT {GRID_COLUMNS} FROM o WHERE place = 1",
    ),
    "best_experiment": (
        lambda s, sf: rounded(S.best_experiment(bundle(s, sf)).select("experiment", *METRICS, "fn")),
        TABLES + LONG_SCORES + bundle_views() + """SELECT grp AS experiment, round("precision", 6) AS "precision", round(recall, 6) AS recall,
        round(f1_score, 6) AS f1_score, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, CAST(fn AS BIGINT) AS fn FROM bundle
        ORDER BY """ + EXPERIMENT_ORDER.format(r=0.95) + " LIMIT 1",
    ),
    "comparison_report": (
        comparison,
        TABLES + LONG_SCORES + bundle_views() + GRID + _best(0.95) + f""", w AS (SELECT grp FROM bundle ORDER BY {EXPERIMENT_ORDER.format(r=0.95)} LIMIT 1)
        SELECT grp AS experiment, grp = (SELECT grp FROM w) AS is_selected, o.threshold AS selected_threshold,
        round(bundle."precision", 6) AS "precision", round(bundle.recall, 6) AS recall, round(bundle.f1_score, 6) AS f1_score,
        round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, CAST(bundle.tn AS BIGINT) AS tn, CAST(bundle.fp AS BIGINT) AS fp,
        CAST(bundle.fn AS BIGINT) AS fn, CAST(bundle.tp AS BIGINT) AS tp, (SELECT string_agg(concat_ws('/', CAST(CAST(threshold AS DECIMAL(4, 2)) AS VARCHAR), tp, tn, fp, fn), ';' ORDER BY position)
          FROM grid WHERE grid.experiment = grp) AS grid
        FROM bundle JOIN o ON o.experiment = bundle.grp AND o.place = 1""",
    ),
    "metric_deltas": (
        lambda s, sf: rounded(S.metric_deltas(bundle(s, sf))),
        TABLES + LONG_SCORES + bundle_views() + DELTAS + f"SELECT {DELTA_COLUMNS} FROM deltas",
    ),
    "promotion_gate": (lambda s, sf: gate(bundle(s, sf)), TABLES + LONG_SCORES + bundle_views() + DELTAS + GATE),
    "promotion_gate_invalid_scores": (
        lambda s, sf: gate(M.metric_bundle(spoilt_scores(s, sf), THRESHOLD)),
        TABLES + LONG_SCORES + SPOILT + bundle_views("spoilt") + DELTAS + GATE,
    ),
    "threshold_grid_invalid_scores": (
        lambda s, sf: rounded(S.threshold_grid(spoilt_scores(s, sf), by=["experiment"])),
        TABLES + LONG_SCORES + SPOILT + GRID.replace("FROM long_scores", "FROM spoilt") + f"SELECT {GRID_COLUMNS} FROM grid",
    ),
}
