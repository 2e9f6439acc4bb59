"""Exploratory aggregates: the data behind each plot."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.config import CORRELATED_COLUMNS
from riskspark.functions import as_number, count_where, ratio, small_table
from riskspark.plans import as_literal, below_cut, exact_quantiles, lowest_hash_cuts

# A variance below this share of the squared range counts as zero.
NO_SPREAD = 1e-24
RISKY_TYPES = ("CASH_OUT", "TRANSFER")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts, largest first; equal counts by value."""
    return df.groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column)


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values (a top-k report), ties by value."""
    return value_counts(df.where(F.col(column).isNotNull()), column).limit(n)


def fraud_rate_by(df: DataFrame, column: str = "type", target: str = "isFraud") -> DataFrame:
    return (
        df.groupBy(column)
        .agg(F.count("*").alias("transactions"),
             F.sum(target).cast("bigint").alias("fraud"),
             F.avg(target).alias("fraud_rate"))
        .orderBy(F.desc("fraud_rate"), column)
    )


def class_pivot(df: DataFrame, column: str = "type", target: str = "isFraud") -> DataFrame:
    """Counts per value and class, zero-filled."""
    return df.groupBy(column).agg(
        count_where(F.col(target) == 0).alias("non_fraud"),
        count_where(F.col(target) == 1).alias("fraud"),
    )


def crosstab_with_margins(df: DataFrame, column: str = "type", target: str = "isFraud") -> DataFrame:
    """Counts per value and class with an ``All`` row and column.

    The rollup runs over the grouped counts, not over the rows.
    """
    counts = df.groupBy(column).agg(
        count_where(F.col(target) == 0).alias("class_0"),
        count_where(F.col(target) == 1).alias("class_1"),
        F.count(target).alias("all_classes"),
    )
    names = ("class_0", "class_1", "all_classes")
    return (
        counts.rollup(column)
        .agg(F.grouping(column).alias("_all"), *[F.sum(n).alias(n) for n in names])
        .select(F.when(F.col("_all") == 1, "All").otherwise(F.col(column)).alias(column), *names)
    )


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max, exact, as (statistic, value) rows."""
    c = F.col(column).cast("double")
    moments = df.where(c.isNotNull() & ~F.isnan(c)).agg(
        F.count(c).alias("count"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"),
    )
    names = {0.25: "25%", 0.5: "50%", 0.75: "75%"}
    label = F.element_at(F.create_map(*[F.lit(v) for kv in names.items() for v in kv]), F.col("fraction"))
    quartiles = exact_quantiles(df, column, list(names)).select(
        label.alias("statistic"), F.col("quantile").alias("value")
    )
    return moments.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("statistic"), F.col(n).cast("double").alias("value"))
        for n in ("count", "mean", "std", "min", "max")
    ]))).unionByName(quartiles)


def approximate_quantiles(df: DataFrame, column: str, fractions: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """One-pass sketch quantiles, rank error at most 1/accuracy."""
    found = F.percentile_approx(column, [float(f) for f in fractions], accuracy)
    return df.agg(found.alias("q")).select(
        F.posexplode("q").alias("i", "quantile")
    ).select(F.element_at(F.array(*[F.lit(float(f)) for f in fractions]), F.col("i") + 1).alias("fraction"),
             "quantile")


def correlation_pairs(df: DataFrame, columns: Sequence[str] = CORRELATED_COLUMNS) -> DataFrame:
    """Pearson correlation of every pair, long and symmetric; null for a constant column.
    NaN counts as missing.

    A first pass gives means and ranges; a second sums products of the centred columns, one
    sum per pair and column.  A pair with missing values gets its own sums over the rows
    where both are present.  Both passes yield one row, from which the table is filled.
    """
    numbers = df.select(*[as_number(c).alias(c) for c in columns])
    first = numbers.agg(
        F.count(F.lit(1)).alias("rows"),
        *[e for c in columns for e in (F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"),
                                       F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))],
    ).first()
    full = {c for c in columns if first[f"n_{c}"] == first["rows"]}
    centred = numbers.select(*[(F.col(c) - F.lit(first[f"m_{c}"] or 0.0)).alias(c) for c in columns])

    pairs = list(combinations_with_replacement(columns, 2))
    sums: dict[str, Column] = {}

    def name(given: tuple[str, str], *factors: str) -> str:
        return "*".join(factors) + ("" if full.issuperset(given) else f"|{given[0]},{given[1]}")

    for pair in pairs:
        for factors in {(), pair, (pair[0],), (pair[1],), (pair[0],) * 2, (pair[1],) * 2}:
            key = name(pair, *factors)
            if key not in sums:
                # as SQL text: one call to the JVM per sum
                term = " * ".join(f"`{f}`" for f in factors) or "1D"
                given = "" if full.issuperset(pair) else " FILTER (WHERE `{}` IS NOT NULL AND `{}` IS NOT NULL)".format(*pair)
                sums[key] = F.expr(f"sum({term}){given}")
    found = centred.agg(*[c.alias(n) for n, c in sums.items()]).first().asDict()

    def correlation(a: str, b: str) -> float | None:
        pair = (a, b)
        n = found[name(pair)]
        if not n:
            return None

        def moment(x: str, y: str) -> float:
            return found[name(pair, x, y)] / n - found[name(pair, x)] / n * found[name(pair, y)] / n

        for c in pair:
            span = first[f"hi_{c}"] - first[f"lo_{c}"]
            # rounding noise of a constant column is no spread
            if not moment(c, c) > NO_SPREAD * span * span:
                return None
        return 1.0 if a == b else moment(a, b) / math.sqrt(moment(a, a) * moment(b, b))

    table = {(x, y): correlation(a, b) for a, b in pairs for x, y in ((a, b), (b, a))}
    return small_table(
        df.sparkSession, [(a, b, r) for (a, b), r in table.items()], "a string, b string, corr double"
    )


def log_histogram(df: DataFrame, value: Column, bins: int = 50) -> DataFrame:
    """Equal-width histogram of log10(value); empty bins are listed with 0."""
    logs = df.select(F.log10(value).alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    ends = logs.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if ends.lo is None:
        return small_table(df.sparkSession, [], "bin int, low double, high double, rows bigint")
    width = (ends.hi - ends.lo) / bins or 1.0
    number = F.least(F.floor((F.col("x") - F.lit(ends.lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = logs.groupBy(number.alias("bin")).agg(F.count("*").alias("rows"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.lit(ends.lo) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(ends.lo) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def box_summary(df: DataFrame, value: Column, by: str = "isFraud") -> DataFrame:
    """Quartiles, whiskers (1.5 IQR, clipped to the data) and outlier counts per class."""
    rows = df.select(F.col(by), value.cast("double").alias("x")).where(
        F.col("x").isNotNull() & ~F.isnan("x")
    )
    q = (
        exact_quantiles(rows, "x", [0.25, 0.5, 0.75], [by])
        .groupBy(by).agg(*[
            F.max(F.when(F.col("fraction") == f, F.col("quantile"))).alias(n)
            for f, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
        ])
    )
    # one row per class
    q = as_literal(q)
    fenced = rows.join(q, by).withColumns({
        "lo_fence": F.col("q1") - (F.col("q3") - F.col("q1")) * F.lit(1.5),
        "hi_fence": F.col("q3") + (F.col("q3") - F.col("q1")) * F.lit(1.5),
    })
    inside = (F.col("x") >= F.col("lo_fence")) & (F.col("x") <= F.col("hi_fence"))
    return fenced.groupBy(by).agg(
        F.count("*").alias("rows"),
        F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        count_where(~inside).alias("outliers"),
    )


def log_amount(column: str = "amount") -> Column:
    return F.log1p(F.col(column))


def log_balance_change() -> Column:
    return F.log1p(F.abs(F.col("oldbalanceOrg") - F.col("newbalanceOrig")))


def stats_by_class(df: DataFrame, column: str = "amount", by: str = "isFraud") -> DataFrame:
    """Rows, mean, median and maximum per class; NaN counts as missing."""
    df = df.select(by, as_number(column).alias(column))
    basic = df.groupBy(by).agg(
        F.count(column).alias("rows"), F.avg(column).alias("mean"), F.max(column).alias("max")
    )
    median = exact_quantiles(df, column, [0.5], [by]).select(by, F.col("quantile").alias("median"))
    return basic.join(median, by, "left")


def flag_rule_efficiency(df: DataFrame, flag: str = "isFlaggedFraud", target: str = "isFraud") -> DataFrame:
    """How many frauds the simple flag rule catches and misses."""
    flagged, fraud = F.col(flag) == 1, F.col(target) == 1
    return df.agg(
        count_where(flagged).alias("flagged"),
        count_where(fraud).alias("fraud"),
        count_where(flagged & fraud).alias("caught"),
        count_where(F.coalesce(F.col(flag) != 1, F.lit(True)) & fraud).alias("missed"),
    ).withColumn("miss_rate", ratio(F.col("missed"), F.col("fraud")))


def type_filter_effect(df: DataFrame, types: Sequence[str] = RISKY_TYPES, target: str = "isFraud") -> DataFrame:
    """What restricting the table to some types keeps and drops."""
    kept = F.coalesce(F.col("type").isin(*types), F.lit(False))
    legit, fraud = F.col(target) == 0, F.col(target) == 1
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        count_where(kept).alias("rows_kept"),
        count_where(kept & fraud).alias("fraud_kept"),
        count_where(fraud).alias("fraud"),
        count_where(~kept & legit).alias("non_fraud_dropped"),
        count_where(legit).alias("non_fraud"),
    ).withColumn("non_fraud_dropped_share", ratio(F.col("non_fraud_dropped"), F.col("non_fraud")))


def restrict_types(df: DataFrame, types: Sequence[str] = RISKY_TYPES) -> DataFrame:
    return df.where(F.col("type").isin(*types))


def drained(df: DataFrame) -> DataFrame:
    """Transfers and cash-outs that empty the sender's account."""
    return restrict_types(df).where((F.col("oldbalanceOrg") > 0) & (F.col("newbalanceOrig") == 0))


def drained_counts(df: DataFrame, target: str = "isFraud") -> DataFrame:
    return drained(df).agg(
        F.count(F.lit(1)).alias("drained"), count_where(F.col(target) == 1).alias("drained_fraud")
    )


def unchanged_recipient(df: DataFrame, target: str = "isFraud") -> DataFrame:
    """Cash-outs by class: all, and those whose recipient balances are both zero."""
    zero = (F.col("oldbalanceDest") == 0) & (F.col("newbalanceDest") == 0)
    return df.where(F.col("type") == "CASH_OUT").groupBy(target).agg(
        F.count("*").alias("rows"),
        count_where(zero).alias("zero_recipient"),
        count_where(F.col("oldbalanceDest") == F.col("newbalanceDest")).alias("unchanged_recipient"),
    )


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct counts per column.

    Unpivoted first, so one shuffle of (column, value) pairs serves every column and
    each pair collapses map-side; a multi-distinct aggregate would expand whole rows.
    """
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]))).where(F.col("value").isNotNull())
    return pairs.groupBy("column", "value").agg(F.lit(1)).groupBy("column").agg(
        F.count("*").alias("distinct_values")
    )


def approximate_cardinality(df: DataFrame, columns: Sequence[str], rsd: float = 0.02) -> DataFrame:
    """Sketch distinct counts: one pass, no shuffle of values."""
    found = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct_values")) for c in columns
    ])))


def fixed_sample(df: DataFrame, key: str, n: int = 100_000, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows in a reproducible choice; a filter, not a sort."""
    cuts = lowest_hash_cuts(df, key, lambda totals: {c: min(n, t) for c, t in totals.items()}, seed=seed)
    return df.where(below_cut(cuts, key, seed=seed))
