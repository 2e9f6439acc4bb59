"""Synthetic minority oversampling (Chawla et al., JAIR 16, 2002) on the training rows.

The neighbour search sees the minority class only.  Which row, neighbour and gap a
synthetic point uses comes from a digest of (key, copy number, seed), so a recomputed
task yields the same points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.config import SmoteConfig
from riskspark.functions import count_where, small_table
from riskspark.operators.neighbours import nearest_neighbours
from riskspark.plans import below_cut, lowest_hash_cuts


# copies of one row that one task unrolls at once
PART_COPIES = 10_000


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def smote(
    train: DataFrame,
    key: str,
    vector: str,
    target: str = "isFraud",
    config: SmoteConfig = SmoteConfig(),
) -> DataFrame:
    """Synthetic rows (base, neighbour, gap, vector, target) that even out the classes.

    Each minority row is used floor(new / minority) times and the first few (by digest)
    once more, so the number of new rows is exactly majority - minority.  Rows that share a key
    are told apart by a running number, which makes keys text ("key#2") where any is shared.
    A minority of at most ``config.k`` rows has too few neighbours and is refused.
    """
    counts = train.agg(
        count_where(F.col(target) == 0).alias("n0"), count_where(F.col(target) == 1).alias("n1")
    ).first()
    minority_class = 1 if counts.n1 <= counts.n0 else 0
    minority, majority = sorted((counts.n0, counts.n1))
    missing = majority - minority
    if missing == 0:
        return _no_rows(train, key, vector, target)
    if minority <= config.k:
        raise ValueError(f"{minority} minority rows have no {config.k} neighbours each")
    pool = _unique_keys(train.where(F.col(target) == minority_class).select(key, vector), key)
    each, extra = divmod(missing, minority)
    cuts = lowest_hash_cuts(pool, key, lambda totals: {c: extra for c in totals}, seed=config.seed)

    found = nearest_neighbours(pool, key, F.col(vector), config.k, config.block_rows, config.max_pivots)
    # at most k entries per row
    choices = found.groupBy("id", "v").agg(
        F.sort_array(F.collect_list(F.struct("rank", "neighbour", "nv"))).alias("near")
    )
    copies = F.lit(each) + below_cut(cuts, "id", seed=config.seed).cast("int")
    pick = F.element_at("near", (F.floor(
        _uniform(F.col("id"), F.col("copy"), F.lit(config.seed), F.lit("neighbour")) * F.size("near")
    ) + 1).cast("int"))
    return (
        _numbered(choices.withColumn("copies", copies).where("copies > 0"))
        .withColumn("near", pick)
        .withColumn("gap", _uniform(F.col("id"), F.col("copy"), F.lit(config.seed), F.lit("gap")))
        .select(
            F.col("id").alias("base"),
            F.col("near.neighbour").alias("neighbour"),
            "copy", "gap",
            F.zip_with("v", "near.nv", lambda a, b: a + F.col("gap") * (b - a)).alias(vector),
            F.lit(minority_class).alias(target),
        )
    )


def _unique_keys(pool: DataFrame, key: str) -> DataFrame:
    if pool.groupBy(key).count().where("count > 1").isEmpty():
        return pool
    # equal keys have equal content, so which of them gets which number does not matter
    number = F.row_number().over(Window.partitionBy(key).orderBy(key))
    text = F.col(key).cast("string")
    return pool.withColumn("_n", number).withColumn(
        key, F.when(F.col("_n") == 1, text).otherwise(F.concat(text, F.lit("#"), F.col("_n")))).drop("_n")


def _numbered(choices: DataFrame) -> DataFrame:
    """One row per copy.  A row with very many copies is first cut into parts of bounded length,
    which spread over the tasks before they are unrolled."""
    parts = choices.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / PART_COPIES).cast("int"))))
    first = F.col("part") * PART_COPIES + 1
    last = F.least(F.col("copies"), first + PART_COPIES - 1)
    return parts.repartition("id", "part").withColumn("copy", F.explode(F.sequence(first, last))).drop("part")


def _no_rows(train: DataFrame, key: str, vector: str, target: str) -> DataFrame:
    kind = train.schema[key].dataType.simpleString()
    return small_table(
        train.sparkSession, [], f"base {kind}, neighbour {kind}, copy int, gap double, {vector} array<double>, {target} int"
    )
