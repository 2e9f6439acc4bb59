"""Operational aggregates over the request log.

Sliding windows are built in two steps: rows collapse into panes as long as the slide,
then pane rows (not log rows) are copied into the windows they belong to.

A logged probability that is none (NaN, infinite, outside [0, 1]) is in no count, rate or bucket; it is
reported as ``invalid_scores``. A null probability is a request without a prediction. A latency that
is null, NaN or infinite was not measured.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.config import LATENCY_BUCKETS_MS, OPERATING_THRESHOLD, PROBABILITY_BUCKETS
from riskspark.functions import at_or_above, count_where, invalid_score, non_finite, ratio
from riskspark.operators.admission import known_category
from riskspark.operators.metrics import confusion, with_prf
from riskspark.plans import split_points, with_bucket
from riskspark.plans.ordered import BUCKET, stored

MIN_DENOMINATOR = 1e-9


def is_error() -> Column:
    return F.col("status") >= 400


def request_totals(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count(F.lit(1)).alias("total"), count_where(is_error()).alias("errors")
    ).withColumn("error_rate", ratio(F.col("errors"), F.col("total")))


def endpoint() -> Column:
    return F.concat_ws(" ", "method", "path")


def requests_by_endpoint(log: DataFrame) -> DataFrame:
    return log.groupBy(endpoint().alias("endpoint")).agg(F.count("*").alias("requests"))


def requests_by_status(log: DataFrame) -> DataFrame:
    return log.groupBy(F.col("status").cast("string").alias("status")).agg(F.count("*").alias("requests"))


def latency() -> Column:
    """The measured latency, else null."""
    return F.when(~non_finite("latency_ms"), F.col("latency_ms"))


def probability_of(name: str = "probability") -> Column:
    """The logged probability, null where it is none."""
    return F.when(~invalid_score(name), F.col(name))


def is_invalid(name: str = "probability") -> Column:
    return F.col(name).isNotNull() & invalid_score(name)


def latency_summary(log: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    return log.withColumn("latency_ms", latency()).agg(
        F.count("latency_ms").alias("count"),
        F.coalesce(F.avg("latency_ms"), zero).alias("average_ms"),
        F.coalesce(F.min("latency_ms"), zero).alias("min_ms"),
        F.coalesce(F.max("latency_ms"), zero).alias("max_ms"),
    )


def prediction_summary(log: DataFrame, threshold: float = OPERATING_THRESHOLD, probability: str = "probability") -> DataFrame:
    """Counts, rate and range of the logged probabilities; rows without one made no prediction."""
    p = probability_of(probability)
    hit = at_or_above(p, threshold)
    return log.where(F.col(probability).isNotNull()).agg(
        F.count(p).alias("total"),
        count_where(hit).alias("fraud"),
        count_where(~hit).alias("non_fraud"),
        F.coalesce(F.avg(p), F.lit(0.0)).alias("average_probability"),
        F.min(p).alias("min_probability"),
        F.max(p).alias("max_probability"),
        count_where(~hit).alias("below_threshold"),
        count_where(hit).alias("at_or_above_threshold"),
        count_where(is_invalid(probability)).alias("invalid_scores"),
    ).withColumn("fraud_rate", ratio(F.col("fraud"), F.col("total")))


def labelled_requests(log: DataFrame) -> DataFrame:
    return log.groupBy("method", F.col("path").alias("endpoint"), F.col("status").cast("string").alias("status")).agg(
        F.count("*").alias("requests")
    )


def error_classes(log: DataFrame) -> DataFrame:
    """Errors by method, endpoint and 4xx / 5xx."""
    return log.where(is_error()).groupBy(
        "method", F.col("path").alias("endpoint"),
        F.concat(F.floor(F.col("status") / 100).cast("string"), F.lit("xx")).alias("status_class"),
    ).agg(F.count("*").alias("errors"))


# --- histograms -------------------------------------------------------------------------

def _cumulative(value: Column, bounds: Sequence[float]) -> list[Column]:
    """count(value <= bound) per bound, then the total; additive over rows and panes."""
    return [count_where(value <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)] + [
        F.count(value).alias(f"le_{len(bounds)}")
    ]


def histogram(
    log: DataFrame, value: Column, bounds: Sequence[float], by: Sequence[str] = (), beside: dict[str, Column] | None = None
) -> DataFrame:
    """Cumulative ``le`` buckets, +Inf last; one pass, at most len(bounds) + 1 rows per group, each with
    the aggregates ``beside``."""
    beside = beside or {}
    wide = log.groupBy(*by).agg(*_cumulative(value, bounds), *[c.alias(n) for n, c in beside.items()])
    labels = [f"{b:g}" for b in bounds] + ["+Inf"]
    return wide.select(*by, *beside, F.inline(F.array(*[
        F.struct(F.lit(label).alias("le"), F.col(f"le_{i}").alias("cumulative"))
        for i, label in enumerate(labels)
    ])))


def probability_histogram(log: DataFrame) -> DataFrame:
    return histogram(log, probability_of(), PROBABILITY_BUCKETS, beside={"invalid_scores": count_where(is_invalid())})


def latency_histogram(log: DataFrame, bounds: Sequence[float] = LATENCY_BUCKETS_MS) -> DataFrame:
    return histogram(log, latency(), bounds)


def bucket_quantile(q: float, bounds: Sequence[float], column=lambda i: f"le_{i}") -> Column:
    """Quantile from cumulative buckets, linear inside the bucket that holds the rank; the
    last finite bound when the rank lies beyond it, null when there is nothing."""
    total = F.col(column(len(bounds)))
    rank = total.cast("double") * F.lit(q)
    found = F.when(total == 0, F.lit(None).cast("double"))
    for i, bound in enumerate(bounds):
        low = bounds[i - 1] if i else min(0.0, bound)
        before = F.col(column(i - 1)) if i else F.lit(0).cast("bigint")
        inside = F.try_divide(rank - before, (F.col(column(i)) - before).cast("double"))
        found = found.when(
            F.col(column(i)) >= rank,
            F.lit(float(low)) + F.lit(float(bound - low)) * F.coalesce(inside, F.lit(0.0)),
        )
    return found.otherwise(F.lit(float(bounds[-1])))


# --- sliding windows ----------------------------------------------------------------------

def sliding(
    log: DataFrame, sums: dict[str, Column], by: Sequence[str] = (), ts: str = "ts",
    minutes: int = 5, slide: int = 1,
) -> DataFrame:
    """Additive aggregates per sliding window: (window_start, by..., sums..., window_end).

    Rows collapse into panes that divide both the window and the slide, so every pane lies
    whole inside each window that holds its start, whatever the two lengths.
    """
    by = list(by)
    pane = F.window(ts, f"{math.gcd(minutes, slide)} minutes").getField("start").alias("_pane")
    panes = log.groupBy(pane, *by).agg(*[c.alias(n) for n, c in sums.items()])
    return (
        panes.groupBy(F.window("_pane", f"{minutes} minutes", f"{slide} minutes").alias("_w"), *by)
        .agg(*[F.sum(n).alias(n) for n in sums])
        .select(F.col("_w.start").alias("window_start"), *by, *sums, F.col("_w.end").alias("window_end"))
    )


def request_sums() -> dict[str, Column]:
    return {"requests": F.count(F.lit(1)), "errors": count_where(is_error())}


def prediction_sums(threshold: float = OPERATING_THRESHOLD) -> dict[str, Column]:
    hit = at_or_above(probability_of(), threshold)
    return {
        "fraud": count_where(hit), "non_fraud": count_where(~hit), "invalid_scores": count_where(is_invalid()),
    }


def add_request_rate(windows: DataFrame, minutes: int = 5) -> DataFrame:
    return windows.withColumn("requests_per_second", F.col("requests").cast("double") / F.lit(60.0 * minutes))


def add_error_rate(windows: DataFrame) -> DataFrame:
    return windows.withColumn(
        "error_rate",
        F.col("errors").cast("double") / F.greatest(F.col("requests").cast("double"), F.lit(MIN_DENOMINATOR)),
    )


def add_fraud_rate(windows: DataFrame) -> DataFrame:
    return windows.withColumn(
        "fraud_rate",
        F.col("fraud").cast("double")
        / F.greatest((F.col("fraud") + F.col("non_fraud")).cast("double"), F.lit(MIN_DENOMINATOR)),
    )


def latency_sums(bounds: Sequence[float] = LATENCY_BUCKETS_MS) -> dict[str, Column]:
    return {f"le_{i}": c for i, c in enumerate(_cumulative(latency(), bounds))}


def add_latency_quantile(windows: DataFrame, q: float, bounds: Sequence[float]) -> DataFrame:
    return windows.select(
        "window_start", "window_end", F.col(f"le_{len(bounds)}").alias("requests"),
        bucket_quantile(q, bounds).alias("quantile_ms"),
    )


def bucket_label(value: Column, bounds: Sequence[float]) -> Column:
    """Upper bound of the bucket holding the value."""
    place = reduce(lambda acc, b: acc + (value > F.lit(float(b))).cast("int"), bounds, F.lit(0))
    return F.element_at(F.array(*[F.lit(f"{b:g}") for b in bounds], F.lit("+Inf")), place + 1)


def request_rate(log: DataFrame, minutes: int = 5, slide: int = 1) -> DataFrame:
    return add_request_rate(sliding(log, request_sums(), minutes=minutes, slide=slide), minutes)


def error_rate(log: DataFrame, minutes: int = 5, slide: int = 1) -> DataFrame:
    return add_error_rate(sliding(log, request_sums(), minutes=minutes, slide=slide))


def latency_quantile(
    log: DataFrame, q: float = 0.95, bounds: Sequence[float] = LATENCY_BUCKETS_MS,
    minutes: int = 5, slide: int = 1,
) -> DataFrame:
    """The q-quantile of latency per window, from bucket counts that add up over panes."""
    return add_latency_quantile(sliding(log, latency_sums(bounds), minutes=minutes, slide=slide), q, bounds)


def exact_latency_quantile(
    log: DataFrame, q: float = 0.95, minutes: int = 60, slide: int | None = None, buckets: int | None = None
) -> DataFrame:
    """The exact q-quantile of latency per window (tumbling without ``slide``), linear between ranks.

    Rows collapse once into counts per pane and value, which add up over panes. Counts per
    pane and bucket of values, copied into the windows instead of rows, show which bucket holds the wanted rank of each
    window; only value counts of those buckets meet the windows of their panes.
    """
    slide = slide or minutes
    step = math.gcd(minutes, slide)
    rows = log.select(F.window("ts", f"{step} minutes").getField("start").alias("_pane"), latency().alias("_v")).where("_v IS NOT NULL")
    placed = with_bucket(rows, "_v", split_points(rows, "_v", buckets))
    counts = stored(placed.groupBy("_pane", BUCKET, "_v").agg(F.count("*").alias("_n")), "pane-values")
    cells = counts.groupBy("_pane", BUCKET).agg(F.sum("_n").alias("_n")).groupBy(
        F.window("_pane", f"{minutes} minutes", f"{slide} minutes").getField("start").alias("window_start"), BUCKET).agg(F.sum("_n").alias("_n"))
    # at most one row per bucket in a window
    below = Window.partitionBy("window_start").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    position = F.lit(float(q)) * (F.col("requests") - 1)
    ranked = cells.select(
        "window_start", BUCKET, "_n", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("window_start")).alias("requests"),
    ).withColumns({"_low": F.floor(position), "_high": F.ceil(position), "_part": position - F.floor(position)})

    def holds(rank: str) -> Column:
        return (F.col(rank) >= F.col("_before")) & (F.col(rank) < F.col("_before") + F.col("_n"))

    wanted = ranked.where(holds("_low") | holds("_high"))
    pane = F.make_dt_interval(mins=F.lit(step))
    panes = F.sequence("window_start", F.col("window_start") + F.make_dt_interval(mins=F.lit(minutes - step)), pane)
    values = wanted.drop("_n").withColumn("_pane", F.explode(panes)).join(counts, ["_pane", BUCKET]).groupBy(
        "window_start", BUCKET, "_before", "requests", "_low", "_high", "_part", "_v").agg(F.sum("_n").alias("_n"))
    inside = Window.partitionBy("window_start", BUCKET).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # from here a row's ranks are those of its value
    upto = values.withColumn("_before", F.col("_before") + F.sum("_n").over(inside) - F.col("_n"))
    low, high = F.min(F.when(holds("_low"), F.col("_v"))), F.min(F.when(holds("_high"), F.col("_v")))
    return upto.groupBy("window_start", "requests").agg((low + (high - low) * F.max("_part")).alias("quantile_ms"))


def sketched_latency_quantile(
    log: DataFrame, q: float = 0.95, minutes: int = 5, slide: int = 1, k: int = 200
) -> DataFrame:
    """The q-quantile of latency per window within a rank error that ``k`` sets (about 1.3 % at 200), from one
    mergeable sketch per pane, however many rows and values it has."""
    step = math.gcd(minutes, slide)
    pane = F.window("ts", f"{step} minutes").getField("start").alias("_pane")
    panes = log.withColumn("latency_ms", latency().cast("double")).where("latency_ms IS NOT NULL").groupBy(pane).agg(
        F.kll_sketch_agg_double("latency_ms", F.lit(k)).alias("_s"))
    window = F.window("_pane", f"{minutes} minutes", f"{slide} minutes").getField("start").alias("window_start")
    merged = panes.groupBy(window).agg(F.kll_merge_agg_double("_s", F.lit(k)).alias("_s"))
    return merged.select("window_start", F.kll_sketch_get_n_double("_s").alias("requests"),
                         F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias("quantile_ms"))


def fraud_rate(log: DataFrame, threshold: float = OPERATING_THRESHOLD, minutes: int = 5, slide: int = 1) -> DataFrame:
    predictions = log.where(F.col("probability").isNotNull())
    return add_fraud_rate(sliding(predictions, prediction_sums(threshold), minutes=minutes, slide=slide))


def probability_heatmap(log: DataFrame, bounds: Sequence[float] = PROBABILITY_BUCKETS, minutes: int = 5, slide: int = 1) -> DataFrame:
    """Predictions per window and upper bucket bound (not cumulative)."""
    rows = log.where(~invalid_score("probability")).withColumn("le", bucket_label(F.col("probability"), bounds))
    return sliding(rows, {"predictions": F.count(F.lit(1))}, ["le"], minutes=minutes, slide=slide)


def quality_errors_over_time(violations: DataFrame, minutes: int = 5, slide: int = 1) -> DataFrame:
    rows = violations.withColumn("category", known_category(F.col("category")))
    return sliding(rows, {"errors": F.count(F.lit(1))}, ["category"], minutes=minutes, slide=slide)


# --- online performance --------------------------------------------------------------------

def label_join(scored: DataFrame, labels: DataFrame, key: str = "txn_id", within_hours: int = 72) -> DataFrame:
    """Scores joined with labels that arrive within the allowed delay (unique keys on both sides)."""
    delay = F.make_dt_interval(hours=F.lit(within_hours))
    joined = scored.join(labels.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key")).drop("_key")
    return joined.where((F.col("label_ts") >= F.col("ts")) & (F.col("label_ts") <= F.col("ts") + delay))


def online_performance(
    scored: DataFrame, labels: DataFrame, threshold: float = OPERATING_THRESHOLD,
    key: str = "txn_id", p: str = "p", within_hours: int = 72,
) -> DataFrame:
    """Confusion counts and P/R/F1 per day of the transaction, from the labels known so far."""
    joined = label_join(scored, labels, key, within_hours).withColumn("day", F.to_date("ts"))
    return with_prf(confusion(joined, threshold, "y", p, ["day"]))
