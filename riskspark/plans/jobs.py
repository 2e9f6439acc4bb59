"""Whole runs: validate and prepare, train and choose, drift, retrain and gate.

Each function chains operators and writes tables or reports under one folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.config import (
    EXPERIMENTS, DriftConfig, Experiment, FeatureConfig, ModelConfig, PromotionCriteria, SmoteConfig,
    SplitConfig, ValidationRules,
)
from riskspark.errors import DataValidationError, ScoringError
from riskspark.functions import small_table
from riskspark.operators import admission as A, drift as D, features as X, metrics as M, selection as S, split as P, train as L, validate as V
from riskspark.sources import readers as R, sinks as W

KEY = "row_key"


def require_scored(inputs: DataFrame, scored: DataFrame, key: str, score: str, what: str) -> None:
    """Stop on scores that are no probability, and on rows that were lost or scored twice."""
    found = A.scored_sanity(scored, score).first()
    if not found.valid:
        raise ScoringError(f"{what}: of {found.rows} scores {found.non_finite} are not finite and "
                           f"{found.outside_unit_interval} lie outside [0, 1]")
    lost = A.lost_rows(inputs, scored, key).count()
    if lost:
        raise ScoringError(f"{what}: {lost} keys have more or fewer scores than rows")


def validate_job(
    spark: SparkSession, raw_path: str, report_path: str, rules: ValidationRules = ValidationRules()
) -> DataFrame:
    """Validate a CSV file, write the report, and stop on a failed verdict."""
    W.write_report(V.validate_csv(spark, raw_path, rules), report_path)
    report = spark.read.schema(V.REPORT_SCHEMA).json(report_path)
    if V.overall_status(report) != "PASSED":
        raise DataValidationError(f"{raw_path} failed validation, see {report_path}")
    return report


def prepare_job(
    raw: DataFrame, out: str, features: FeatureConfig = FeatureConfig(), partition_by: Sequence[str] = ()
) -> DataFrame:
    """Preprocess, then add features, each written once; gives both stage reports."""
    spark = raw.sparkSession
    first = W.write_with_stage_report(raw, X.preprocess, f"{out}/preprocessed.parquet", "preprocess", partition_by)
    kept = spark.read.parquet(f"{out}/preprocessed.parquet")
    second = W.write_with_stage_report(kept, lambda df: X.add_features(df, features), f"{out}/cleaned.parquet", "features", partition_by)
    return first.unionByName(second)


def train_job(
    table: DataFrame, out: str, key: str | None = None, target: str = "isFraud",
    experiments: Sequence[Experiment] = EXPERIMENTS, model: ModelConfig = ModelConfig(),
    split: SplitConfig = SplitConfig(), smote: SmoteConfig = SmoteConfig(), min_recall: float = 0.95,
    *, model_name: str,
) -> tuple[PipelineModel, DataFrame]:
    """Fit every experiment, choose one and its threshold, save its pipeline.

    ``table`` has the six request fields and the target.  Gives the chosen pipeline and the
    comparison report, which is also written as JSON.
    """
    if key is None:
        key, table = KEY, X.with_row_key(table, KEY)
    scored, fitted = L.run_experiments(table, key, target, experiments, model, split, smote, f"{out}/scored")
    _, test = P.train_test(table, key, target, split)
    for e in experiments:
        require_scored(test, scored.where(F.col("experiment") == e.name), key, "p", e.name)
    metrics = M.metric_bundle(scored, 0.5)
    W.write_report(S.comparison_report(metrics, scored, min_recall=min_recall), f"{out}/comparison")
    report = table.sparkSession.read.json(f"{out}/comparison")
    chosen = report.where("is_selected").first().experiment
    L.save_model(fitted[chosen], f"{out}/model")
    settings = small_table(
        table.sparkSession, [(e.name, e.use_smote, e.use_class_weight) for e in experiments],
        "experiment string, use_smote boolean, use_class_weight boolean",
    )
    thresholds = S.best_threshold(S.threshold_grid(scored, by=["experiment"]), min_recall, ["experiment"])
    W.write_report(S.model_metadata(metrics, thresholds, settings, model_name, min_recall), f"{out}/metadata")
    return fitted[chosen], report


def drift_job(
    spark: SparkSession, reference_path: str, current_path: str, out: str,
    sample_size: int | None = None, key: str | None = None,
    config: DriftConfig = DriftConfig(), method: str = "distance",
) -> DataFrame:
    """Load, check, compare, and write per-feature results and the summary as JSON."""
    reference = R.load_drift_table(spark, reference_path, sample_size, key)
    current = R.load_drift_table(spark, current_path, sample_size, key)
    per_feature, summary = D.compare(reference, current, config, method)
    W.write_report(per_feature, f"{out}/features")
    W.write_report(summary, f"{out}/summary")
    return spark.read.json(f"{out}/summary")


def same_holdout(
    test: DataFrame, models: dict[str, PipelineModel], key: str, target: str, threshold: float, path: str
) -> DataFrame:
    """All models over the same rows: ``experiment``, the key, ``y`` and ``p``, written under ``path``.
    Stops on scores that are none and on rows that were lost or scored twice."""
    for name, fitted in models.items():
        L.score(test, fitted, threshold, keep=[key, target]).select(
            key, F.col(target).alias("y"), F.col(L.PROBABILITY).alias("p")
        ).write.mode("overwrite").parquet(f"{path}/experiment={name}")
    scored = test.sparkSession.read.parquet(path)
    for name in models:
        require_scored(test, scored.where(F.col("experiment") == name), key, "p", name)
    return scored


def retrain_job(
    raw: DataFrame, champion: PipelineModel, out: str, key: str | None = None, target: str = "isFraud",
    rules: ValidationRules = ValidationRules(), model: ModelConfig = ModelConfig(),
    split: SplitConfig = SplitConfig(), criteria: PromotionCriteria = PromotionCriteria(), run: str | None = None,
) -> DataFrame:
    """Validate new data, fit a candidate, score it and the champion on the same test rows,
    and append the gate's decision to the log.  Promotion itself is left to a person.
    A job that is repeated under the name ``run`` logs its decision once."""
    V.require_valid(raw, rules)
    X.require_target(raw, target)
    if key is None:
        key, raw = KEY, X.with_row_key(raw, KEY)
    train, test = P.train_test(raw, key, target, split)
    candidate = L.fit(train, key, target, model, use_smote=False, use_class_weight=True)
    L.save_model(candidate, f"{out}/candidate")
    scored = same_holdout(test, {"candidate": candidate, "champion": champion}, key, target, model.threshold, f"{out}/scored")
    metrics = M.metric_bundle(scored, model.threshold)
    W.append_decisions(S.promotion_gate(S.metric_deltas(metrics), criteria), f"{out}/decisions", run)
    return W.read_decisions(raw.sparkSession, f"{out}/decisions")
