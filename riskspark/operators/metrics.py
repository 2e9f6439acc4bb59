"""Exact classifier metrics over a scored table (label column y, score column p).

Every rank metric comes from one pass: scores collapse to (score, positives, negatives)
rows and get running sums by the bucketed plan of ``ordered_cumsum``.

One rule for scores that are no probability (null, NaN, infinite, outside [0, 1]): they are in
no count, rank or curve, and every table of counts says how many they were (``invalid_scores``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.functions import at_or_above, count_where, invalid_score, ratio
from riskspark.plans import ordered_cumsum

COUNTS = ("tn", "fp", "fn", "tp")


def to_long(scored: DataFrame, scores: dict[str, str], keep: Sequence[str] = ("y",)) -> DataFrame:
    """Several score columns as (experiment, keep..., p) rows, one scan for all."""
    return scored.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(name).alias("experiment"), F.col(c).alias("p")) for name, c in scores.items()
    ])))


def confusion(scored: DataFrame, threshold: float, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp with score >= threshold as positive (always four cells), and invalid_scores."""
    hit, bad = at_or_above(F.col(p), threshold), invalid_score(p)
    pos, neg = (F.col(y) == 1) & ~bad, (F.col(y) == 0) & ~bad
    return scored.groupBy(*by).agg(
        count_where(neg & ~hit).alias("tn"), count_where(neg & hit).alias("fp"),
        count_where(pos & ~hit).alias("fn"), count_where(pos & hit).alias("tp"),
        count_where(bad).alias("invalid_scores"),
    )


def precision() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def recall() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def f1_score() -> Column:
    return ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn"))


def with_prf(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 (0 where the denominator is 0) to confusion counts."""
    return counts.withColumns({"precision": precision(), "recall": recall(), "f1_score": f1_score()})


def ranked(scored: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """One row per distinct valid score with running and total counts of both classes."""
    scored = scored.where(~invalid_score(p))
    sums = {"pos": (F.col(y) == 1).cast("int"), "neg": (F.col(y) == 0).cast("int")}
    return ordered_cumsum(scored, p, sums, by, buckets)


def _auc_term() -> Column:
    """Share of (positive, negative) pairs ranked right at this score; ties count half."""
    wins = F.col("cum_neg") - F.col("neg") + F.col("neg") / F.lit(2.0)
    return F.try_divide(F.col("pos").cast("double"), F.col("total_pos")) * F.try_divide(wins, F.col("total_neg"))


def _tp() -> Column:
    return F.col("total_pos") - F.col("cum_pos") + F.col("pos")


def _fp() -> Column:
    return F.col("total_neg") - F.col("cum_neg") + F.col("neg")


def _ap_term() -> Column:
    """Recall gained at this score times precision there."""
    return F.try_divide(F.col("pos").cast("double"), F.col("total_pos")) * F.try_divide(
        _tp().cast("double"), _tp() + _fp()
    )


def roc_auc(scored: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    return ranked(scored, y, p, by, buckets).groupBy(*by).agg(F.sum(_auc_term()).alias("roc_auc"))


def average_precision(scored: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    return ranked(scored, y, p, by, buckets).groupBy(*by).agg(F.sum(_ap_term()).alias("pr_auc"))


def metric_bundle(
    scored: DataFrame, threshold: float, y: str = "y", p: str = "p",
    by: Sequence[str] = ("experiment",), buckets: int | None = None,
) -> DataFrame:
    """Rows, invalid scores, confusion counts, precision, recall, F1, ROC-AUC and average
    precision per group.

    The confusion counts come from the ranked rows, so the scored table is read once for the
    counts, once for the cut points, and once for the rows and invalid scores of each group;
    a group without any valid score still has its row.
    """
    hit = F.col(p) >= F.lit(float(threshold))
    zero = F.lit(0).cast("bigint")
    table = ranked(scored, y, p, by, buckets).groupBy(*by).agg(
        F.sum(F.when(~hit, F.col("neg")).otherwise(zero)).alias("tn"),
        F.sum(F.when(hit, F.col("neg")).otherwise(zero)).alias("fp"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(zero)).alias("fn"),
        F.sum(F.when(hit, F.col("pos")).otherwise(zero)).alias("tp"),
        F.sum(_auc_term()).alias("roc_auc"),
        F.sum(_ap_term()).alias("pr_auc"),
    )
    whole = scored.groupBy(*by).agg(
        F.count("*").alias("test_samples"), count_where(invalid_score(p)).alias("invalid_scores"))
    # without groups both sides are one row
    keys = list(by) or ["_one"]
    if not by:
        whole, table = whole.withColumn("_one", F.lit(1)), table.withColumn("_one", F.lit(1))
    renamed = table.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = whole.join(renamed, same, "left").drop(*[f"_{k}" for k in keys], "_one")
    return with_prf(joined.withColumns({c: F.coalesce(c, zero) for c in COUNTS}))


def _with_last(table: DataFrame, by: Sequence[str], point: Column, last: Column) -> DataFrame:
    """One point per ranked row, plus ``last`` after the largest score of each group."""
    return table.select(*by, F.inline(
        F.when(F.col("next_value").isNull(), F.array(point, last)).otherwise(F.array(point))
    ))


def _point(**values: Column | float | None) -> Column:
    return F.struct(*[
        (v if isinstance(v, Column) else F.lit(v)).cast("double").alias(n) for n, v in values.items()
    ])


def _curve_values() -> tuple[Column, Column, Column]:
    """False positive rate, recall and precision of "this score or above"."""
    return (
        F.try_divide(_fp().cast("double"), F.col("total_neg")),
        F.try_divide(_tp().cast("double"), F.col("total_pos")),
        F.try_divide(_tp().cast("double"), _tp() + _fp()),
    )


def roc_curve(scored: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the (0, 0) start with a null threshold."""
    fpr, tpr, _ = _curve_values()
    return _with_last(
        ranked(scored, y, p, by, buckets), by,
        _point(threshold=F.col(p), fpr=fpr, tpr=tpr), _point(threshold=None, fpr=0.0, tpr=0.0),
    )


def pr_curve(scored: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the (1, 0) end with a null threshold."""
    _, rec, prec = _curve_values()
    return _with_last(
        ranked(scored, y, p, by, buckets), by,
        _point(threshold=F.col(p), precision=prec, recall=rec),
        _point(threshold=None, precision=1.0, recall=0.0),
    )


def thin_curve(curve: DataFrame, points: int, order: str = "threshold") -> DataFrame:
    """At most about ``points`` rows for plotting: the first row of each equal-width slice."""
    ends = curve.agg(F.min(order).alias("lo"), F.max(order).alias("hi")).first()
    if ends.lo is None or ends.hi == ends.lo:
        return curve
    width = (ends.hi - ends.lo) / points
    slice_no = F.floor((F.col(order) - F.lit(ends.lo)) / F.lit(width))
    return curve.groupBy(slice_no.alias("_slice")).agg(
        F.min_by(F.struct(*curve.columns), F.struct(order, *[c for c in curve.columns if c != order])).alias("_r")
    ).select("_r.*")


def best_f1_threshold(scored: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """The score with the largest 2PR / (P + R + 1e-6); the lowest one on ties."""
    f1 = F.lit(2.0) * F.col("precision") * F.col("recall") / (
        F.col("precision") + F.col("recall") + F.lit(1e-6)
    )
    _, rec, prec = _curve_values()
    points = ranked(scored, y, p, by, buckets).select(
        *by, F.col(p).alias("threshold"), prec.alias("precision"), rec.alias("recall")
    ).withColumn("f1", f1).where(F.col("f1").isNotNull())
    return points.groupBy(*by).agg(
        F.max_by(F.struct("threshold", "precision", "recall", "f1"),
                 F.struct(F.col("f1"), -F.col("threshold"))).alias("best")
    ).select(*by, "best.*")


def classification_report(scored: DataFrame, threshold: float, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Per class, accuracy, macro and support-weighted rows: (label, precision, recall, f1, support)."""
    c = {n: F.col(n).cast("double") for n in COUNTS}
    n0, n1 = c["tn"] + c["fp"], c["fn"] + c["tp"]
    n = n0 + n1
    p0, r0, f0 = ratio(c["tn"], c["tn"] + c["fn"]), ratio(c["tn"], n0), ratio(2 * c["tn"], 2 * c["tn"] + c["fp"] + c["fn"])
    p1, r1, f1 = ratio(c["tp"], c["tp"] + c["fp"]), ratio(c["tp"], n1), ratio(2 * c["tp"], 2 * c["tp"] + c["fp"] + c["fn"])
    accuracy = ratio(c["tn"] + c["tp"], n)

    def row(label: str, prec: Column, rec: Column, f: Column, support: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), prec.alias("precision"), rec.alias("recall"),
                        f.alias("f1_score"), support.cast("bigint").alias("support"))

    def macro(a: Column, b: Column) -> Column:
        return (a + b) / F.lit(2.0)

    def weighted(a: Column, b: Column) -> Column:
        return ratio(a * n0 + b * n1, n)

    return confusion(scored, threshold, y, p, by).select(*by, F.inline(F.array(
        row("0", p0, r0, f0, n0),
        row("1", p1, r1, f1, n1),
        row("accuracy", accuracy, accuracy, accuracy, n),
        row("macro avg", macro(p0, p1), macro(r0, r1), macro(f0, f1), n),
        row("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), n),
    )))
