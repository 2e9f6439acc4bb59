"""One-hot and standard scaling as explicit projections, usable as pipeline stages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.config import NUMERIC_FEATURES, TRANSACTION_TYPES, FeatureConfig
from riskspark.functions import as_number, free_name, is_numeric, is_string
from riskspark.plans.ordered import stored

VECTOR = "features"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_string(f.dataType)]


def categories(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values; the first is the reference level that gets no column.

    Every level becomes a column of the result, so their number is that of columns wanted.
    """
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def one_hot(column: str, levels: Sequence[str]) -> dict[str, Column]:
    """1.0 / 0.0 per level but the first; unknown and null values give all zeros."""
    return {
        f"{column}_{level}": F.when(F.col(column) == level, F.lit(1.0)).otherwise(F.lit(0.0))
        for level in sorted(levels)[1:]
    }


def level_table(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Every level of ``column`` with its ``slot``, and how many there are.

    Slots count from 0 in ascending order of the levels after the first; the first level has the
    last slot. Levels are sorted over all tasks; only the row counts of the sorted parts, one
    number per task, meet the driver.
    """
    spark = df.sparkSession
    levels = df.where(F.col(column).isNotNull()).select(F.col(column).alias("level")).distinct()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inside = Window.partitionBy("part").orderBy("level")
    numbered = stored(
        levels.repartitionByRange(parts, "level").withColumn("part", F.spark_partition_id())
        .withColumn("place", F.row_number().over(inside) - 1), "levels")
    counts = sorted((r.part, r["count"]) for r in numbered.groupBy("part").count().collect())
    before, total = {}, 0
    for part, n in counts:
        before[part], total = total, total + n
    if not total:
        return numbered.select("level", F.lit(0).alias("slot")), 0
    offset = F.element_at(F.create_map(*[F.lit(v) for pair in before.items() for v in pair]), F.col("part"))
    slot = F.pmod(F.col("place") + offset - 1, F.lit(total))
    return numbered.select("level", slot.cast("int").alias("slot")), total


def one_hot_vectors(df: DataFrame, column: str, out: str = "onehot") -> DataFrame:
    """``df`` with a sparse 1.0 / 0.0 vector for the levels but the first, for columns of any number
    of levels; unknown and null values give all zeros, as the first level does."""
    levels, n = level_table(df, column)
    level, slot = free_name(df, "level"), free_name(df, "slot")
    joined = df.join(levels.withColumnsRenamed({"level": level, "slot": slot}), F.col(column) == F.col(level), "left").drop(level)
    # the last slot gets no entry; the encoder wants at least two
    known = F.when(F.col(slot) < n - 1, F.col(slot)).otherwise(max(n, 2) - 1).cast("double")
    meta = {"ml_attr": {"type": "nominal", "num_vals": max(n, 2)}}
    placed = joined.withColumn(slot, known.alias(slot, metadata=meta))
    return OneHotEncoder(inputCol=slot, outputCol=out, dropLast=True).fit(placed).transform(placed).drop(slot)


@dataclass(frozen=True)
class Scaler:
    """Mean and population standard deviation per column."""

    moments: dict[str, tuple[float, float]]

    def column(self, name: str) -> Column:
        mean, std = self.moments[name]
        return (F.col(name) - F.lit(mean)) / F.lit(std)


def fit_scaler(df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> Scaler:
    """One aggregation, NaN as missing; a constant column gets divisor 1 and so becomes 0."""
    row = df.agg(*[
        e for c in columns
        for e in (F.avg(as_number(c)).alias(f"mean__{c}"), F.stddev_pop(as_number(c)).alias(f"std__{c}"))
    ]).first()
    return Scaler({
        c: (float(row[f"mean__{c}"] or 0.0), float(row[f"std__{c}"] or 0.0) or 1.0) for c in columns
    })


def standardize(df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    scaler = fit_scaler(df, columns)
    return df.withColumns({c: scaler.column(c) for c in columns})


# --- the same as stages of built-in transformers, so that a pipeline can be saved -----

def feature_stage(config: FeatureConfig = FeatureConfig()) -> SQLTransformer:
    parts = ["*"]
    if config.balance_diffs:
        parts += ["oldbalanceOrg - newbalanceOrig AS balance_diff_orig",
                  "newbalanceDest - oldbalanceDest AS balance_diff_dest"]
    if config.amount_ratio:
        parts.append("try_divide(amount, oldbalanceOrg + 1.0D) AS amount_to_balance_ratio")
    return SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")


def encode_stages(
    scaler: Scaler,
    levels: Sequence[str] = TRANSACTION_TYPES,
    category: str = "type",
    vector: str = VECTOR,
) -> list:
    """Scaled numbers then one-hot columns, assembled into one vector."""
    scaled = [f"(`{c}` - ({m!r}D)) / ({s!r}D) AS `z_{c}`" for c, (m, s) in scaler.moments.items()]
    hot = [
        f"CASE WHEN `{category}` = '{level}' THEN 1.0D ELSE 0.0D END AS `is_{level}`"
        for level in sorted(levels)[1:]
    ]
    names = [f"z_{c}" for c in scaler.moments] + [f"is_{level}" for level in sorted(levels)[1:]]
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(scaled + hot)} FROM __THIS__"),
        VectorAssembler(inputCols=names, outputCol=vector, handleInvalid="keep"),
    ]
