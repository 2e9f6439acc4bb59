"""Threshold grids, the best threshold and experiment, and promotion gates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.config import METRICS, THRESHOLD_GRID, PromotionCriteria
from riskspark.functions import at_or_above, count_where, invalid_score, non_finite
from riskspark.operators.metrics import with_prf


def threshold_grid(
    scored: DataFrame, thresholds: Sequence[float] | None = None,
    y: str = "y", p: str = "p", by: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts, P/R/F1 and invalid scores at each threshold: one scan for the whole grid.

    Each score is placed once among the sorted thresholds; counts per place (at most
    len(grid) + 1 rows per group) are then summed from the top.
    """
    grid = list(thresholds or THRESHOLD_GRID)
    levels = sorted(set(grid))
    place = reduce(
        lambda acc, t: acc + at_or_above(F.col(p), t).cast("int"), levels, F.lit(0)
    )
    place = F.when(invalid_score(p), F.lit(-1)).otherwise(place)
    counted = scored.groupBy(*by, place.alias("place")).agg(
        count_where(F.col(y) == 1).alias("pos"), count_where(F.col(y) == 0).alias("neg"),
        F.count("*").alias("n"),
    )
    # a grid position sees a place as "at or above" when place >= rank of its threshold
    ranks = {t: i + 1 for i, t in enumerate(levels)}
    cells = counted.groupBy(*by).agg(
        F.collect_list(F.when(F.col("place") >= 0, F.struct("place", "pos", "neg"))).alias("cells"),
        F.coalesce(F.sum(F.when(F.col("place") < 0, F.col("n"))), F.lit(0).cast("bigint")).alias("invalid_scores"),
    )

    def total(field: str, rank: int, above: bool) -> Column:
        def counts(cell: Column) -> Column:
            return cell["place"] >= rank if above else cell["place"] < rank

        return F.aggregate(
            F.filter("cells", counts), F.lit(0).cast("bigint"), lambda acc, cell: acc + cell[field]
        )

    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(float(t)).alias("threshold"),
            total("neg", ranks[t], False).alias("tn"), total("neg", ranks[t], True).alias("fp"),
            total("pos", ranks[t], False).alias("fn"), total("pos", ranks[t], True).alias("tp"),
            F.col("invalid_scores"),
        )
        for i, t in enumerate(grid)
    ]
    return with_prf(cells.select(*by, F.inline(F.array(*rows))))


def _pick(table: DataFrame, order: Sequence[Column], by: Sequence[str]) -> DataFrame:
    """The row with the largest order key per group, by a partial aggregate."""
    names = [c for c in table.columns if c not in by]
    return table.groupBy(*by).agg(
        F.max_by(F.struct(*names), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])).alias("r")
    ).select(*by, "r.*")


def best_threshold(grid: DataFrame, min_recall: float = 0.95, by: Sequence[str] = ()) -> DataFrame:
    """Highest F1 among thresholds with enough recall, else highest recall; grid order on ties."""
    enough = F.coalesce(F.col("recall"), F.lit(0.0)) >= min_recall
    key = F.when(enough, F.col("f1_score")).otherwise(F.col("recall"))
    return _pick(grid, [enough, F.coalesce(key, F.lit(0.0)), -F.col("position")], by)


def best_experiment(
    metrics: DataFrame, min_recall: float = 0.95, by: Sequence[str] = (), position: str = "experiment"
) -> DataFrame:
    """Among experiments with enough recall (all, if none has): highest PR-AUC, then fewest
    false negatives (unknown last), then highest F1, then ``position``.

    ``metrics`` has one row per experiment, so the window holds a handful of rows.
    """
    def of(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy(
        (of("recall") >= min_recall).desc(), of("pr_auc").desc(),
        F.coalesce(F.col("fn").cast("double"), F.lit(float("inf"))), of("f1_score").desc(), position,
    )
    return metrics.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def comparison_report(
    metrics: DataFrame, scored: DataFrame, thresholds: Sequence[float] | None = None,
    min_recall: float = 0.95,
) -> DataFrame:
    """Every experiment's metrics, which one is selected, and its grid and best threshold.

    ``scored`` holds (experiment, y, p).  One row per experiment; ``threshold_analysis`` is
    filled for all of them, so the selected one carries its own grid.
    """
    chosen = best_experiment(metrics, min_recall).select(F.col("experiment").alias("selected"))
    grid = threshold_grid(scored, thresholds, by=["experiment"])
    best = best_threshold(grid, min_recall, ["experiment"]).select(
        "experiment", F.col("threshold").alias("selected_threshold")
    )
    analysis = grid.groupBy("experiment").agg(F.sort_array(F.collect_list(F.struct(
        "position", "threshold", "precision", "recall", "f1_score", "tp", "tn", "fp", "fn"
    ))).alias("threshold_analysis"))
    criteria = F.lit(f"recall >= {min_recall}; highest pr_auc; fewest fn; highest f1_score")
    return (
        metrics.join(best, "experiment").join(analysis, "experiment")
        .join(chosen, F.col("experiment") == F.col("selected"), "left")
        .withColumn("is_selected", F.col("selected").isNotNull()).drop("selected")
        .withColumn("criteria", criteria)
    )


def model_metadata(
    metrics: DataFrame, chosen_threshold: DataFrame, experiments: DataFrame, model_name: str,
    min_recall: float = 0.95, default_threshold: float = 0.5,
) -> DataFrame:
    """The deployment candidate as (model, experiment, use_smote, use_class_weight, threshold,
    selected, metric, value): its metrics at the default and at the selected threshold."""
    chosen = best_experiment(metrics, min_recall).join(experiments, "experiment")
    head = ["experiment", "use_smote", "use_class_weight"]

    def rows(table: DataFrame, threshold: Column, selected: bool, names: Sequence[str]) -> DataFrame:
        return table.select(
            F.lit(model_name).alias("model"), *head, threshold.cast("double").alias("threshold"),
            F.lit(selected).alias("selected"),
            F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names])))

    at_selected = chosen.select(*head).join(chosen_threshold, "experiment")
    return rows(chosen, F.lit(default_threshold), False, METRICS).unionByName(
        rows(at_selected, F.col("threshold"), True, ("precision", "recall", "f1_score", "fp", "fn")))


# --- promotion ------------------------------------------------------------------------

def metric_deltas(metrics: DataFrame, candidate: str = "candidate", champion: str = "champion",
                  name: str = "experiment", by: Sequence[str] = ()) -> DataFrame:
    """Candidate minus champion: one row per group with both values and the delta of each metric."""
    def of(model: str, column: str) -> Column:
        return F.max(F.when(F.col(name) == model, F.col(column)))

    sides = metrics.groupBy(*by).agg(
        *[of(candidate, m).alias(f"candidate_{m}") for m in METRICS],
        *[of(champion, m).alias(f"champion_{m}") for m in METRICS],
        *[of(model, c).alias(f"{side}_{c}") for c in ("fn", "test_samples", "invalid_scores")
          for side, model in (("candidate", candidate), ("champion", champion))],
    )
    return sides.withColumns(
        {f"{m}_delta": F.col(f"candidate_{m}") - F.col(f"champion_{m}") for m in METRICS}
    )


def promotion_gate(deltas: DataFrame, criteria: PromotionCriteria = PromotionCriteria()) -> DataFrame:
    """PROMOTE when every gate holds, else REJECT with the failed gates in order.

    A model that scores a row with anything but a probability, or other rows than its rival,
    cannot be compared, whatever its metrics over the rest.
    """
    def holds(metric: str, least: float) -> Column:
        return F.coalesce(at_or_above(F.col(f"{metric}_delta"), least), F.lit(False))

    checks = {
        "recall": holds("recall", criteria.min_recall_delta),
        "pr_auc": holds("pr_auc", criteria.min_pr_auc_delta),
        "f1_score": holds("f1_score", criteria.min_f1_delta),
        "false_negatives": F.coalesce(F.col("candidate_fn") <= F.col("champion_fn"), F.lit(False)),
        "candidate_metrics_valid": ~reduce(
            lambda a, b: a | b, [non_finite(f"candidate_{m}") for m in METRICS]
        ),
        "scores_valid": F.coalesce(
            (F.col("candidate_invalid_scores") == 0) & (F.col("champion_invalid_scores") == 0), F.lit(False)),
        "same_rows": F.coalesce(
            F.col("candidate_test_samples") == F.col("champion_test_samples"), F.lit(False)),
    }
    gated = deltas.withColumns({f"check_{n}": c for n, c in checks.items()})
    failed = F.filter(
        F.array(*[F.when(~F.col(f"check_{n}"), F.lit(n)) for n in checks]), lambda x: x.isNotNull()
    )
    gated = gated.withColumn("failed_criteria", failed)
    none = F.size("failed_criteria") == 0
    return gated.withColumns({
        "decision": F.when(none, "PROMOTE").otherwise("REJECT"),
        "approval_state": F.when(none, "PENDING_APPROVAL").otherwise("REJECTED"),
        "reason": F.when(none, "candidate holds every gate").otherwise(
            F.concat(F.lit("candidate misses: "), F.array_join("failed_criteria", ", "))
        ),
    })
