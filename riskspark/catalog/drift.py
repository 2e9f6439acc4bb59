"""Drift between early and late transactions, unshifted and shifted."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog.shape import rounded
from riskspark.catalog.tables_sql import TABLES
from riskspark.config import FEATURES, NUMERIC_FEATURES, DriftConfig
from riskspark.operators import drift as R, features as X
from riskspark.sources import testdata as D

def drift_views(reference: str, current: str) -> str:
    """Plain windows over the values of each feature, and shares of each type."""
    return f""",
ref AS ({reference}),
cur AS ({current}),
long AS (""" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {f} AS v, 0 AS side FROM ref UNION ALL SELECT '{f}', {f}, 1 FROM cur" for f in NUMERIC_FEATURES
) + """),
vals AS (SELECT feature, v, count(*) FILTER (WHERE side = 0) AS r, count(*) FILTER (WHERE side = 1) AS c FROM long GROUP BY feature, v),
cums AS (SELECT feature, v, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY feature) AS tr, sum(c) OVER (PARTITION BY feature) AS tc,
  lead(v) OVER w AS nv FROM vals WINDOW w AS (PARTITION BY feature ORDER BY v)),
spread AS (SELECT feature, stddev_pop(v) AS std FROM long WHERE side = 0 GROUP BY feature),
num AS (SELECT c.feature, CAST(max(tr) AS BIGINT) AS reference_rows, CAST(max(tc) AS BIGINT) AS current_rows,
  sum(abs(CAST(cr AS DOUBLE) / tr - CAST(cc AS DOUBLE) / tc) * coalesce(nv - v, 0)) AS wasserstein,
  max(abs(CAST(cr AS DOUBLE) / tr - CAST(cc AS DOUBLE) / tc)) AS ks, max(std) AS std,
  sum(abs(CAST(cr AS DOUBLE) / tr - CAST(cc AS DOUBLE) / tc) * coalesce(nv - v, 0)) / greatest(max(std), 0.001) AS normed_wasserstein
  FROM cums c JOIN spread s ON s.feature = c.feature GROUP BY c.feature),
cats AS (SELECT type, count(*) FILTER (WHERE side = 0) AS r, count(*) FILTER (WHERE side = 1) AS c FROM
  (SELECT type, 0 AS side FROM ref UNION ALL SELECT type, 1 FROM cur) GROUP BY type),
shares AS (SELECT type, c, CAST(r AS DOUBLE) / sum(r) OVER () AS p, CAST(c AS DOUBLE) / sum(c) OVER () AS q, sum(r) OVER () AS tr, sum(c) OVER () AS tc FROM cats),
cat AS (SELECT 'type' AS feature, CAST(max(tr) AS BIGINT) AS reference_rows, CAST(max(tc) AS BIGINT) AS current_rows,
  sqrt((sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END) + sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)) / 2) AS jensen_shannon,
  sum((c - p * tc) * (c - p * tc) / (p * tc)) AS chi_square, count(*) - 1 AS df FROM shares),
feat AS (SELECT feature, 'normed_wasserstein' AS method, normed_wasserstein AS drift_score FROM num UNION ALL SELECT feature, 'jensen_shannon', jensen_shannon FROM cat)
"""


PAIR = drift_views(
    "SELECT * FROM featured WHERE step <= 360",
    "SELECT * REPLACE (amount * 2 AS amount, 'TRANSFER' AS type) FROM featured WHERE step > 360",
)


def pair(s, sf):
    return D.drift_pair(X.add_features(D.transactions(s, sf)))


def summary(s, sf, method):
    reference, current = pair(s, sf)
    _, found = R.compare(reference, current, DriftConfig(), method)
    return rounded(found)


def score_pair(s, sf):
    """Champion scores of the early steps against candidate scores of the late ones."""
    t = D.transactions(s, sf)
    scored = D.scored_from(t.where("step <= 360")), D.scored_from(t.where("step > 360"))
    return scored[0].select(F.col("p_champion").alias("p")), scored[1].select(F.col("p_candidate").alias("p"))


def missing(s, sf):
    dirty = X.add_features(D.dirty(s, sf))
    return R.missing_counts(dirty.where("step <= 360"), dirty.where("step > 360"), FEATURES)


QUERIES = {
    "drift_wasserstein": (
        lambda s, sf: rounded(R.numeric_distances(*pair(s, sf), NUMERIC_FEATURES).drop("ks")),
        TABLES + PAIR + """SELECT feature, reference_rows, current_rows, round(wasserstein, 6) AS wasserstein, round(std, 6) AS std,
        round(normed_wasserstein, 6) AS normed_wasserstein FROM num""",
    ),
    "drift_ks": (
        lambda s, sf: rounded(R.numeric_distances(*pair(s, sf), NUMERIC_FEATURES).select("feature", "ks")),
        TABLES + PAIR + "SELECT feature, round(ks, 6) AS ks FROM num",
    ),
    "drift_js": (
        lambda s, sf: rounded(R.categorical_distances(*pair(s, sf), ["type"]).select("feature", "jensen_shannon")),
        TABLES + PAIR + "SELECT feature, round(jensen_shannon, 6) AS jensen_shannon FROM cat",
    ),
    "drift_chi2": (
        lambda s, sf: rounded(R.categorical_distances(*pair(s, sf), ["type"]).select("feature", "chi_square", "df", "reference_rows", "current_rows")),
        TABLES + PAIR + "SELECT feature, round(chi_square, 6) AS chi_square, df, reference_rows, current_rows FROM cat",
    ),
    "drift_features": (
        lambda s, sf: rounded(R.feature_drift(*pair(s, sf))),
        TABLES + PAIR + """SELECT feature, method, round(drift_score, 6) AS drift_score, CAST(0.1 AS DOUBLE) AS drift_threshold,
        drift_score >= 0.1 AS drift_detected FROM feat""",
    ),
    "drift_p_values": (
        lambda s, sf: rounded(R.feature_drift(*pair(s, sf), method="p_value")),
        # five types give four degrees of freedom: the tail is exp(-x/2) (1 + x/2)
        TABLES + PAIR + """, x AS (SELECT feature, ks * sqrt(CAST(reference_rows AS DOUBLE) * current_rows / (reference_rows + current_rows)) AS x FROM num),
        p AS (SELECT feature, 'ks_p_value' AS method, CASE WHEN max(x) < 0.04 THEN 1 ELSE least(greatest(
            sum(CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END * exp(CAST(-2 AS DOUBLE) * j * j * x * x)), 0), 1) END AS s
          FROM x CROSS JOIN range(1, 101) r(j) GROUP BY feature
          UNION ALL SELECT feature, 'chi_square_p_value', exp(-chi_square / 2) * (1 + chi_square / 2) FROM cat WHERE df = 4)
        SELECT feature, method, round(s, 6) AS drift_score, CAST(0.05 AS DOUBLE) AS drift_threshold, s < 0.05 AS drift_detected FROM p""",
    ),
    "drift_summary": (
        lambda s, sf: summary(s, sf, "distance"),
        TABLES + PAIR + """SELECT string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drift_score >= 0.1) AS drifted_features,
        count(*) FILTER (WHERE drift_score >= 0.1) AS drifted, round(count(*) FILTER (WHERE drift_score >= 0.1) / CAST(9 AS DOUBLE), 6) AS drift_share,
        CAST(0.5 AS DOUBLE) AS drift_share_threshold, count(*) FILTER (WHERE drift_score >= 0.1) / CAST(9 AS DOUBLE) >= 0.5 AS dataset_drift_detected,
        count(*) FILTER (WHERE drift_score >= 0.1) > 0 AS investigation_required,
        CAST((SELECT count(*) FROM ref) AS INT) AS reference_rows, CAST((SELECT count(*) FROM cur) AS INT) AS current_rows FROM feat""",
    ),
    "drift_missing": (
        missing,
        TABLES + """, df AS (SELECT *, oldbalanceOrg - newbalanceOrig AS balance_diff_orig, newbalanceDest - oldbalanceDest AS balance_diff_dest,
        CASE WHEN oldbalanceOrg = -1 THEN NULL ELSE amount / (oldbalanceOrg + CAST(1 AS DOUBLE)) END AS amount_to_balance_ratio FROM dirty) """
        + " UNION ALL ".join(
            f"SELECT '{f}' AS feature, count(*) FILTER (WHERE step <= 360 AND {f} IS NULL) AS reference_missing, "
            f"count(*) FILTER (WHERE step > 360 AND {f} IS NULL) AS current_missing FROM df" for f in FEATURES),
    ),
    "drift_scores": (
        lambda s, sf: rounded(R.score_drift(*score_pair(s, sf), "p", 0.9)),
        TABLES + """, a AS (SELECT p_champion AS v, 0 AS side FROM scored JOIN transactions USING (txn_id) WHERE step <= 360
          UNION ALL SELECT p_candidate, 1 FROM scored JOIN transactions USING (txn_id) WHERE step > 360),
        vals AS (SELECT v, count(*) FILTER (WHERE side = 0) AS r, count(*) FILTER (WHERE side = 1) AS c FROM a GROUP BY v),
        cums AS (SELECT v, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER () AS tr, sum(c) OVER () AS tc, lead(v) OVER w AS nv FROM vals WINDOW w AS (ORDER BY v)),
        num AS (SELECT sum(abs(CAST(cr AS DOUBLE) / tr - CAST(cc AS DOUBLE) / tc) * coalesce(nv - v, 0)) / (SELECT greatest(stddev_pop(v), 0.001) FROM a WHERE side = 0) AS s FROM cums),
        cats AS (SELECT v >= 0.9 AS d, CAST(count(*) FILTER (WHERE side = 0) AS DOUBLE) / (SELECT count(*) FROM a WHERE side = 0) AS p,
          CAST(count(*) FILTER (WHERE side = 1) AS DOUBLE) / (SELECT count(*) FROM a WHERE side = 1) AS q FROM a GROUP BY 1),
        js AS (SELECT sqrt(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2) AS s FROM cats),
        u AS (SELECT 'probability' AS feature, 'normed_wasserstein' AS method, s FROM num UNION ALL SELECT 'decision', 'jensen_shannon', s FROM js)
        SELECT feature, method, round(s, 6) AS drift_score, CAST(0.1 AS DOUBLE) AS drift_threshold, s >= 0.1 AS drift_detected,
          CAST(0 AS BIGINT) AS reference_invalid_scores, CAST(0 AS BIGINT) AS current_invalid_scores FROM u""",
    ),
}
