"""Exact, reproducible train/test split and class weights."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from riskspark.config import SplitConfig
from riskspark.functions import count_where
from riskspark.plans import below_cut, hash_cut_table, lowest_hash_cuts, with_cut_table

SPLIT = "split"


def test_quotas(totals: DataFrame, test_size: float) -> DataFrame:
    """(cls, n, want): ceil(share * rows) test rows in all, spread over the classes by largest remainder, ties by
    the class as text. The window is over one row per class."""
    whole = totals.agg(F.sum("n").alias("rows")).first()
    rows = whole.rows or 0
    wanted = math.ceil(test_size * rows)
    exact = F.lit(float(wanted)) * F.col("n") / F.lit(float(max(rows, 1)))
    shares = totals.select("cls", "n", F.floor(exact).alias("low"), (exact - F.floor(exact)).alias("part"))
    spare = wanted - (shares.agg(F.sum("low")).first()[0] or 0)
    place = F.row_number().over(Window.orderBy(F.desc("part"), F.col("cls").cast("string")))
    return shares.select("cls", "n", (F.col("low") + (place <= spare).cast("long")).alias("want"))


test_quotas.__test__ = False  # not a pytest case


def assign_split(df: DataFrame, key: str, target: str = "isFraud", config: SplitConfig = SplitConfig()) -> DataFrame:
    """Add ``split`` = train / test with exact sizes: a comparison with the cut of the row's class."""
    if config.stratify:
        cuts = hash_cut_table(df, key, lambda totals: test_quotas(totals, config.test_size), target, config.seed)
        marked = with_cut_table(df, cuts, SPLIT, key, target, config.seed)
    else:
        cuts = lowest_hash_cuts(df, key, lambda t: {c: math.ceil(config.test_size * n) for c, n in t.items()}, seed=config.seed)
        marked = df.withColumn(SPLIT, below_cut(cuts, key, seed=config.seed))
    return marked.withColumn(SPLIT, F.when(F.col(SPLIT), "test").otherwise("train"))


def train_test(df: DataFrame, key: str, target: str = "isFraud", config: SplitConfig = SplitConfig()) -> tuple[DataFrame, DataFrame]:
    marked = assign_split(df, key, target, config)
    return (marked.where(F.col(SPLIT) == "train").drop(SPLIT),
            marked.where(F.col(SPLIT) == "test").drop(SPLIT))


def split_audit(marked: DataFrame, target: str = "isFraud") -> DataFrame:
    """Rows per split and class."""
    return marked.groupBy(SPLIT, target).agg(F.count("*").alias("rows"))


def class_weight_table(train: DataFrame, target: str = "isFraud", enabled: bool = True) -> DataFrame:
    """Class counts and the weight of the positive class (1 when disabled or without one)."""
    counts = train.agg(
        count_where(F.col(target) == 0).alias("negatives"),
        count_where(F.col(target) == 1).alias("positives"),
    )
    weight = F.col("negatives").cast("double") / F.col("positives").cast("double")
    use = F.lit(enabled) & (F.col("positives") > 0)
    return counts.withColumn("positive_weight", F.when(use, weight).otherwise(F.lit(1.0)))


def with_class_weight(train: DataFrame, target: str = "isFraud", enabled: bool = True, out: str = "weight") -> DataFrame:
    weight = class_weight_table(train, target, enabled).first().positive_weight if enabled else 1.0
    return train.withColumn(out, F.when(F.col(target) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
