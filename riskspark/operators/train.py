"""Boosted-tree training, imbalance experiments, hyper-parameter search and scoring.

Boosting takes Newton steps on the logistic loss: each round fits one regression tree to the step
(y - p) / (p (1 - p)) with weight p (1 - p), so that a leaf holds the step of its rows, as in LogitBoost
(Friedman, Hastie and Tibshirani, Annals of Statistics 28, 2000), whose bound on single steps keeps rare
rows from running away. Columns are drawn once per tree: the others are blanked, and no tree splits on a
constant. The trees form a ``GBTClassificationModel``, so scoring, saving and loading are MLlib's.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskspark.config import (
    EXPERIMENTS, NUMERIC_FEATURES, Experiment, FeatureConfig, ModelConfig, SmoteConfig, SplitConfig,
)
from riskspark.errors import ScoringError
from riskspark.functions import at_or_above, small_table
from riskspark.operators import forest, trees
from riskspark.operators.encode import VECTOR, categories, encode_stages, feature_stage, fit_scaler
from riskspark.operators.features import add_features
from riskspark.operators.resample import smote
from riskspark.operators.split import train_test, with_class_weight
from riskspark.session import ensure_checkpoint_dir, scratch_path

WEIGHT = "weight"
PROBABILITY = "fraud_probability"


#: The largest single Newton step, in log odds.
LARGEST_STEP = 4.0


def draw_columns(columns: int, share: float, trees: int, seed: int) -> list[list[int]]:
    """The columns each tree may use: ``share`` of all, at least one, drawn anew per tree."""
    rng = random.Random(seed)
    n = max(1, math.floor(share * columns + 0.5))
    return [sorted(rng.sample(range(columns), n)) for _ in range(trees)]


def boost(rows: DataFrame, target: str = "isFraud", config: ModelConfig = ModelConfig()) -> tuple[GBTClassificationModel, list[list[int]]]:
    """A boosted model of ``rows`` (vector, target, weight), and the columns each tree was given.

    Which rows a tree sees follows from a hash of row number and round, so a recomputed task sees the same.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    start = rows.select(vector_to_array(VECTOR).alias("x"), F.col(target).cast("double").alias("y"),
                        F.col(WEIGHT).cast("double").alias("w"), F.monotonically_increasing_id().alias("row"))
    # written once, as every row keeps its number and the bins need a pass of their own
    path = scratch_path(spark, "boosting")
    start.write.parquet(path)
    table = spark.read.schema(start.schema).parquet(path)
    found = table.agg(F.count("*").alias("rows"), F.max(F.size("x")).alias("size")).first()
    if not found.rows:
        raise ValueError("no rows to fit a model on")
    drawn = draw_columns(found.size, config.column_subsample, config.trees, config.seed)
    cuts = trees.cut_points(table, found.size)
    grown = trees.grow(table, found.rows, cuts, drawn, config.depth, config.learning_rate, config.row_subsample, config.seed,
                       LARGEST_STEP)
    with ThreadPoolExecutor(1) as maker:  # a tree becomes MLlib's, node by node, while the next one grows
        members = [maker.submit(trees.as_model, spark, tree, cuts) for tree in grown]
    # MLlib's probability is that of twice the weighted sum
    return _ensemble(spark, [m.result() for m in members], config.learning_rate / 2, found.size), drawn


def _ensemble(spark: SparkSession, members: Sequence, weight: float, size: int) -> GBTClassificationModel:
    sc = spark.sparkContext
    jvm = sc._jvm
    models = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(members))
    weights = sc._gateway.new_array(sc._gateway.jvm.double, len(members))
    for i, member in enumerate(members):
        models[i], weights[i] = member, weight
    uid = f"GBTClassifier_{members[0].uid().rsplit('_', 1)[-1]}"
    return GBTClassificationModel(
        jvm.org.apache.spark.ml.classification.GBTClassificationModel(uid, models, weights, size, 2)).setFeaturesCol(VECTOR)


def fit(
    train: DataFrame,
    key: str,
    target: str = "isFraud",
    model: ModelConfig = ModelConfig(),
    use_smote: bool = False,
    use_class_weight: bool = True,
    smote_config: SmoteConfig = SmoteConfig(),
    features: FeatureConfig = FeatureConfig(),
) -> PipelineModel:
    """Fit on raw training rows; the result scores rows with the six request fields.

    The pipeline holds built-in stages only, so it saves and loads as it is.  The class
    weight counts the rows before oversampling.
    """
    ensure_checkpoint_dir(train.sparkSession)
    featured = add_features(train, features)
    columns = [c for c in NUMERIC_FEATURES if c in featured.columns]
    stages = [feature_stage(features), *encode_stages(fit_scaler(featured, columns), categories(train, "type"))]
    prepared = Pipeline(stages=stages).fit(train)
    encoded = prepared.transform(train).select(key, VECTOR, target)
    weighted = with_class_weight(encoded, target, use_class_weight, WEIGHT)
    rows = weighted.select(VECTOR, target, WEIGHT)
    synthetic = None
    if use_smote:
        arrays = encoded.withColumn(VECTOR, vector_to_array(VECTOR))
        # written once: boosting reads its input several times, and the search is costly
        synthetic = scratch_path(train.sparkSession, "synthetic")
        smote(arrays, key, VECTOR, target, smote_config).write.parquet(synthetic)
        made = train.sparkSession.read.parquet(synthetic)
        minority = with_class_weight_value(weighted, target)
        rows = rows.unionByName(
            made.select(array_to_vector(VECTOR).alias(VECTOR), F.col(target).cast("int").alias(target),
                        F.when(F.col(target) == 1, F.lit(minority)).otherwise(F.lit(1.0)).alias(WEIGHT))
        )
    booster, drawn = boost(rows, target, model)
    fitted = PipelineModel(stages=[*prepared.stages, booster])
    names = prepared.stages[-1].getInputCols()
    # which columns each tree was given, by name, and the table of synthetic rows
    fitted.tree_columns, fitted.synthetic_path = [[names[c] for c in columns] for columns in drawn], synthetic
    return fitted


def with_class_weight_value(weighted: DataFrame, target: str) -> float:
    """The weight positives carry."""
    row = weighted.where(F.col(target) == 1).agg(F.max(WEIGHT).alias("w")).first()
    return float(row.w or 1.0)


def save_model(model: PipelineModel, path: str) -> str:
    """The pipeline, and beside it the columns each tree was given."""
    model.write().overwrite().save(path)
    drawn = getattr(model, "tree_columns", None)
    if drawn:
        spark = SparkSession.getActiveSession()
        small_table(spark, list(enumerate(drawn)), "tree int, columns array<string>").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/tree_columns")
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_tree_columns(spark: SparkSession, path: str) -> list[list[str]]:
    return [list(r.columns) for r in spark.read.parquet(f"{path}/tree_columns").orderBy("tree").collect()]


# --- scoring --------------------------------------------------------------------------

def _require_binary(model: Model) -> None:
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if getattr(last, "numClasses", 0) != 2:
        raise ScoringError("the model does not give a probability of class 1")


def decide(probability: Column, threshold: float) -> Column:
    return at_or_above(probability, threshold)


def score(df: DataFrame, model: PipelineModel, threshold: float = ModelConfig().threshold,
          keep: Sequence[str] | None = None) -> DataFrame:
    """Probability of class 1 and the decision; the same call serves batch and stream.

    A row takes many trees' time and few bytes, so the rows of a batch are dealt out over all cores first, however few
    files they lie in. Boosted trees take whole batches of rows (``forest``); any other model scores as MLlib does.
    """
    _require_binary(model)
    columns = list(keep if keep is not None else df.columns)
    rows = df if df.isStreaming else df.hint("rebalance")
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    members = forest.members(last) if isinstance(last, GBTClassificationModel) else None
    if members:
        before = PipelineModel(stages=model.stages[:-1]).transform(rows) if isinstance(model, PipelineModel) else rows
        scored = before.withColumn(PROBABILITY, forest.probability(members, vector_to_array(last.getFeaturesCol())))
    else:
        scored = model.transform(rows).withColumn(PROBABILITY, vector_to_array("probability")[1])
    return (
        scored.select(*columns, PROBABILITY)
        .withColumn("is_fraud", decide(F.col(PROBABILITY), threshold))
        .withColumn("threshold", F.lit(float(threshold)))
    )


# --- experiments -------------------------------------------------------------------------

def run_experiments(
    df: DataFrame,
    key: str,
    target: str = "isFraud",
    experiments: Sequence[Experiment] = EXPERIMENTS,
    model: ModelConfig = ModelConfig(),
    split: SplitConfig = SplitConfig(),
    smote_config: SmoteConfig = SmoteConfig(),
    path: str | None = None,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Every imbalance strategy fitted on one split and scored on the same test rows.

    Gives (experiment, key, y, p) and the fitted pipelines.  The scores are written once
    as a table (``path``, or a fresh one in the shared folder): later metrics read it
    several times, and none of them should score again or depend on lost executors.
    """
    path = path or scratch_path(df.sparkSession, "experiments")
    train, test = train_test(df, key, target, split)
    train, test = train.persist(), test.persist()
    fitted = {}
    for e in experiments:
        fitted[e.name] = fit(train, key, target, model, e.use_smote, e.use_class_weight, smote_config)
        score(test, fitted[e.name], model.threshold, keep=[key, target]).select(
            key, F.col(target).alias("y"), F.col(PROBABILITY).alias("p")
        ).write.mode("overwrite").parquet(f"{path}/experiment={e.name}")
    train.unpersist()
    test.unpersist()
    return df.sparkSession.read.parquet(path).select("experiment", key, "y", "p"), fitted


class BoostingEstimator(Estimator):
    """``fit`` as an estimator of raw rows: scaler, levels, class weight and oversampling come from the rows it
    is fitted on. Inside a cross-validation these are the folds trained on, and synthetic rows never
    reach an evaluation, as the fitted pipeline only scores.
    """

    maxIter = Param(Params._dummy(), "maxIter", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "learning rate", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows per tree", TypeConverters.toFloat)
    columnShare = Param(Params._dummy(), "columnShare", "share of columns per tree", TypeConverters.toFloat)

    def __init__(
        self, key: str, target: str = "isFraud", model: ModelConfig = ModelConfig(), use_smote: bool = True,
        use_class_weight: bool = True, smote_config: SmoteConfig = SmoteConfig(),
    ):
        super().__init__()
        self.key, self.target, self.model = key, target, model
        self.use_smote, self.use_class_weight, self.smote_config = use_smote, use_class_weight, smote_config
        self._setDefault(maxIter=model.trees, maxDepth=model.depth, stepSize=model.learning_rate,
                         subsamplingRate=model.row_subsample, columnShare=model.column_subsample)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        value = self.getOrDefault
        config = replace(self.model, trees=value(self.maxIter), depth=value(self.maxDepth), learning_rate=value(self.stepSize),
                         row_subsample=value(self.subsamplingRate), column_subsample=value(self.columnShare))
        return fit(dataset, self.key, self.target, config, self.use_smote, self.use_class_weight, self.smote_config)


# The grid the random search draws from.
SEARCH_GRID = {
    "maxIter": (200, 500, 800),
    "maxDepth": (4, 6, 8, 10),
    "stepSize": (0.01, 0.05, 0.1),
    "subsamplingRate": (0.7, 0.9, 1.0),
    "columnShare": (0.7, 0.9, 1.0),
}


def search(
    train: DataFrame,
    key: str,
    target: str = "isFraud",
    draws: int = 20,
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 2,
    grid: dict[str, Sequence] | None = None,
    use_smote: bool = True,
    use_class_weight: bool = True,
    smote_config: SmoteConfig = SmoteConfig(),
    keep_models: bool = False,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Random search: distinct draws from the grid, cross-validated by F1 of class 1.

    Folds come from a digest of the key. Encoding, weights and oversampling are fitted on the folds
    trained on. Gives the fitted search and a table (draw, one column per parameter, mean_f1).
    """
    grid = grid or SEARCH_GRID
    size = 1
    for values in grid.values():
        size *= len(values)
    places = random.Random(seed).sample(range(size), min(draws, size))

    def settings(place: int) -> dict[str, object]:
        chosen = {}
        for name, values in grid.items():
            place, i = divmod(place, len(values))
            chosen[name] = values[i]
        return chosen

    chosen = [settings(p) for p in places]
    ensure_checkpoint_dir(train.sparkSession)
    estimator = BoostingEstimator(key, target, ModelConfig(seed=seed), use_smote, use_class_weight, smote_config)
    rows = train.withColumn("fold", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(folds)).cast("int"))
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=[{estimator.getParam(n): v for n, v in c.items()} for c in chosen],
        evaluator=MulticlassClassificationEvaluator(
            labelCol=target, metricName="fMeasureByLabel", metricLabel=1.0
        ),
        numFolds=folds, foldCol="fold", seed=seed, parallelism=parallelism, collectSubModels=keep_models,
    )
    fitted = validator.fit(rows)
    table = small_table(
        train.sparkSession,
        [(i, *[str(c[n]) for n in grid], float(f1)) for i, (c, f1) in enumerate(zip(chosen, fitted.avgMetrics))],
        "draw int, " + ", ".join(f"{n} string" for n in grid) + ", mean_f1 double",
    )
    return fitted, table
