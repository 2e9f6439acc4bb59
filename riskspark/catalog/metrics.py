"""Classifier metrics over the scored table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog.shape import rounded
from riskspark.catalog.tables_sql import LONG_SCORES, TABLES, VALID, bundle_views, rank_views
from riskspark.operators import metrics as M
from riskspark.sources import testdata as D

THRESHOLD = 0.9
BOTH = {"candidate": "p_candidate", "champion": "p_champion"}


def long_scores(spark, sf, keep=("y",)):
    return M.to_long(D.scored(spark, sf), BOTH, keep)


def spoilt_scores(spark, sf):
    """Both models' scores, the candidate's partly null, NaN, infinite or above 1."""
    at = {n: (F.col("experiment") == "candidate") & (F.col("txn_id") % n == 0) for n in (97, 101, 103, 107)}
    p = F.when(at[97], F.lit(None)).when(at[101], F.lit(float("nan"))).when(at[103], F.lit(float("inf"))).when(
        at[107], F.lit(1.5)).otherwise(F.col("p"))
    return long_scores(spark, sf, ("y", "txn_id")).withColumn("p", p)


def candidate(spark, sf):
    return D.scored(spark, sf).withColumnRenamed("p_candidate", "p")


CONFUSION = f""", c AS (SELECT experiment, count(*) FILTER (WHERE y = 0 AND {VALID} AND p < 0.9) AS tn, count(*) FILTER (WHERE y = 0 AND {VALID} AND p >= 0.9) AS fp,
  count(*) FILTER (WHERE y = 1 AND {VALID} AND p < 0.9) AS fn, count(*) FILTER (WHERE y = 1 AND {VALID} AND p >= 0.9) AS tp,
  count(*) FILTER (WHERE NOT {VALID}) AS invalid_scores FROM long_scores GROUP BY experiment)
"""
# the candidate's scores with some that are no probability
SPOILT = """,
spoilt AS (
  SELECT experiment, y, CASE WHEN experiment <> 'candidate' THEN p WHEN txn_id % 97 = 0 THEN NULL WHEN txn_id % 101 = 0 THEN CAST('nan' AS DOUBLE)
    WHEN txn_id % 103 = 0 THEN CAST('inf' AS DOUBLE) WHEN txn_id % 107 = 0 THEN 1.5 ELSE p END AS p FROM long_scores)
"""
PRF = """round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS "precision",
  round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1_score"""
BUNDLE_COLUMNS = """test_samples, CAST(invalid_scores AS BIGINT) AS invalid_scores, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
  round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
  round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc"""

REPORT = """, c AS (SELECT CAST(count(*) FILTER (WHERE y = 0 AND p_candidate < 0.5) AS DOUBLE) AS tn, CAST(count(*) FILTER (WHERE y = 0 AND p_candidate >= 0.5) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (WHERE y = 1 AND p_candidate < 0.5) AS DOUBLE) AS fn, CAST(count(*) FILTER (WHERE y = 1 AND p_candidate >= 0.5) AS DOUBLE) AS tp FROM scored),
k AS (SELECT tn + fp AS n0, fn + tp AS n1, tn + fp + fn + tp AS n, (tn + tp) / (tn + fp + fn + tp) AS acc,
  coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0, coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f0,
  coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM c),
r AS (SELECT '0' AS label, p0 AS a, r0 AS b, f0 AS c, n0 AS support FROM k UNION ALL SELECT '1', p1, r1, f1, n1 FROM k
  UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM k UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM k
  UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n, (f0 * n0 + f1 * n1) / n, n FROM k)
SELECT label, round(a, 6) AS "precision", round(b, 6) AS recall, round(c, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM r"""

QUERIES = {
    "confusion": (
        lambda s, sf: M.confusion(long_scores(s, sf), THRESHOLD, by=["experiment"]),
        TABLES + LONG_SCORES + CONFUSION + "SELECT * FROM c",
    ),
    "confusion_invalid_scores": (
        lambda s, sf: M.confusion(spoilt_scores(s, sf), THRESHOLD, by=["experiment"]),
        TABLES + LONG_SCORES + SPOILT + CONFUSION.replace("long_scores", "spoilt") + "SELECT * FROM c",
    ),
    "metrics_invalid_scores": (
        lambda s, sf: rounded(M.metric_bundle(spoilt_scores(s, sf), THRESHOLD)),
        TABLES + LONG_SCORES + SPOILT + bundle_views("spoilt") + f"SELECT grp AS experiment, {BUNDLE_COLUMNS} FROM bundle",
    ),
    "prf": (
        lambda s, sf: rounded(M.with_prf(M.confusion(long_scores(s, sf), THRESHOLD, by=["experiment"])).drop(*M.COUNTS, "invalid_scores")),
        TABLES + LONG_SCORES + CONFUSION + f"SELECT experiment, {PRF} FROM c",
    ),
    "roc_auc": (
        lambda s, sf: rounded(M.roc_auc(long_scores(s, sf), by=["experiment"])),
        TABLES + LONG_SCORES + bundle_views() + "SELECT grp AS experiment, round(roc_auc, 6) AS roc_auc FROM bundle",
    ),
    "average_precision": (
        lambda s, sf: rounded(M.average_precision(long_scores(s, sf), by=["experiment"])),
        TABLES + LONG_SCORES + bundle_views() + "SELECT grp AS experiment, round(pr_auc, 6) AS pr_auc FROM bundle",
    ),
    "roc_curve": (
        lambda s, sf: rounded(M.roc_curve(long_scores(s, sf), by=["experiment"])),
        TABLES + LONG_SCORES + rank_views() + """SELECT grp AS experiment, round(p, 6) AS threshold, round(CAST(fp AS DOUBLE) / tot_neg, 6) AS fpr,
        round(CAST(tp AS DOUBLE) / tot_pos, 6) AS tpr FROM ranked UNION ALL SELECT DISTINCT grp, CAST(NULL AS DOUBLE), 0, 0 FROM ranked""",
    ),
    "pr_curve": (
        lambda s, sf: rounded(M.pr_curve(long_scores(s, sf), by=["experiment"])),
        TABLES + LONG_SCORES + rank_views() + """SELECT grp AS experiment, round(p, 6) AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS "precision",
        round(CAST(tp AS DOUBLE) / tot_pos, 6) AS recall FROM ranked UNION ALL SELECT DISTINCT grp, CAST(NULL AS DOUBLE), 1, 0 FROM ranked""",
    ),
    "classification_report": (
        lambda s, sf: rounded(M.classification_report(candidate(s, sf), 0.5)), TABLES + REPORT,
    ),
    "metrics_by_experiment": (
        lambda s, sf: rounded(M.metric_bundle(long_scores(s, sf), THRESHOLD)),
        TABLES + LONG_SCORES + bundle_views() + f"SELECT grp AS experiment, {BUNDLE_COLUMNS} FROM bundle",
    ),
    "metrics_by_type": (
        lambda s, sf: rounded(M.metric_bundle(candidate(s, sf), THRESHOLD, by=["type"])),
        TABLES + LONG_SCORES + bundle_views("(SELECT * FROM long_scores WHERE experiment = 'candidate')", "type")
        + f"SELECT grp AS type, {BUNDLE_COLUMNS} FROM bundle",
    ),
    "best_f1_threshold": (
        lambda s, sf: rounded(M.best_f1_threshold(long_scores(s, sf), by=["experiment"])),
        TABLES + LONG_SCORES + rank_views() + """, pr AS (SELECT grp, p, CAST(tp AS DOUBLE) / (tp + fp) AS pre, CAST(tp AS DOUBLE) / tot_pos AS rec FROM ranked),
        f AS (SELECT *, CAST(2 AS DOUBLE) * pre * rec / (pre + rec + CAST(1e-6 AS DOUBLE)) AS f1 FROM pr),
        o AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY f1 DESC, p) AS place FROM f)
        SELECT grp AS experiment, round(p, 6) AS threshold, round(pre, 6) AS "precision", round(rec, 6) AS recall, round(f1, 6) AS f1 FROM o WHERE place = 1""",
    ),
}
