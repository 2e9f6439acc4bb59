"""Global order without a single-task window.

A running sum over all rows by ``Window.orderBy(x)`` puts the whole table in one
task.  Here rows are first cut into ordered, disjoint buckets at sketch
quantiles; windows then run per bucket, and a table of bucket totals (at most
``buckets`` rows per key) supplies what lies below.  The answer is exact wherever
the cut points fall; they only balance the work.

The cut points are fetched once and become literals.  Left inside the plan, a
recomputed sketch could differ between the two branches that use it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.session import scratch_path

BUCKET = "_bucket"
# Buckets per shuffle partition at least: several, so that hashing them spreads the load evenly.
BUCKETS_PER_PARTITION = 4
# Rows of a bucket at most, about: what one task sorts at ease.
BUCKET_ROWS = 2_000_000
# Bucket totals and wanted ranks become a literal table up to this many rows.
LITERAL_ROWS = 100_000
# The sketch sees this share of the rows; precision only affects balance.
SKETCH_SHARE = 0.05
SKETCH_GROUPS = 256
SKETCH_POINTS = 256
# From this many rows per value on, collapsing all ties before the shuffle pays.
COLLAPSE_FROM = 4.0


def default_buckets(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, BUCKETS_PER_PARTITION * partitions)


class Sketch(NamedTuple):
    """Cut points, and how many sampled rows share a value on average."""

    points: list[float]
    rows_per_value: float = 1.0


def sketch(
    df: DataFrame, order: str, buckets: int | None = None, share: float = SKETCH_SHARE, seen: float | None = None
) -> Sketch:
    """``buckets - 1`` cut points in order, repeated where one value fills whole buckets.

    Without ``buckets`` their number follows the rows: several per shuffle partition, and more
    where a bucket would exceed ``BUCKET_ROWS``. ``seen`` is the share of all rows that ``df``
    sampled by ``share`` holds, where it is not ``share`` itself.

    One column of a row sample is sketched.  Sketches are merged in two steps: per group
    of input partitions, then a weighted quantile over the groups' few points, so no
    single task merges the sketches of all input tasks.  A table too small to be sampled
    gets no cut points, hence one bucket.
    """
    if buckets == 1:
        return Sketch([])
    c = F.col(order).cast("double")
    grid = _literal_array((i + 0.5) / SKETCH_POINTS for i in range(SKETCH_POINTS))
    groups = (
        df.select(c.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
        .sample(fraction=min(1.0, share), seed=42)
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group"))
        .agg(F.expr(f"percentile_approx(_x, {grid}, {10 * SKETCH_POINTS})").alias("_points"),
             F.approx_count_distinct("_x").alias("_values"), F.count("*").alias("_rows"))
    )
    # at most SKETCH_GROUPS rows of SKETCH_POINTS values
    found = [r for r in groups.collect() if r["_points"]]
    if not found:
        return Sketch([])
    rows = sum(r["_rows"] for r in found)
    buckets = buckets or max(default_buckets(df), math.ceil(rows / (seen or share) / BUCKET_ROWS))
    if buckets < 2:
        return Sketch([])
    points = np.concatenate([r["_points"] for r in found])
    weights = np.concatenate([np.full(len(r["_points"]), r["_rows"] / len(r["_points"])) for r in found])
    by_value = np.argsort(points, kind="stable")
    reached = np.cumsum(weights[by_value])
    at = np.searchsorted(reached, reached[-1] * np.arange(1, buckets) / buckets)
    cuts = points[by_value][np.minimum(at, len(points) - 1)]
    return Sketch(cuts.tolist(), rows / max(1, sum(r["_values"] for r in found)))


def split_points(df: DataFrame, order: str, buckets: int | None = None, share: float = SKETCH_SHARE) -> list[float]:
    return sketch(df, order, buckets, share).points


def _literal_array(values: Iterable[float]) -> str:
    """As SQL text: one call to the JVM instead of one per value."""
    return "array(" + ", ".join(f"{v!r}D" for v in values) + ")"


def heavy_values(points: Sequence[float]) -> list[float]:
    """Values that fill at least a whole bucket on their own: the repeated cut points."""
    return sorted(v for v, n in Counter(points).items() if n > 1)


def with_bucket(df: DataFrame, order: str, points: Sequence[float]) -> DataFrame:
    """Add the ordered bucket number: bucket i covers [points[i-1], points[i])."""
    if not points:
        return df.withColumn(BUCKET, F.lit(0))
    splits = [float("-inf"), *sorted(set(points)), float("inf")]
    placed = Bucketizer(
        splits=splits, inputCol=order, outputCol=BUCKET, handleInvalid="keep"
    ).transform(df)
    # as an integer: grouping on a double re-normalises it, and the partitioning would be lost
    return placed.withColumn(BUCKET, F.col(BUCKET).cast("int"))


def as_literal(table: DataFrame, most: int = LITERAL_ROWS) -> DataFrame:
    """A small table fetched and turned into a literal one, whose known size lets Spark
    broadcast it; a larger one unchanged, to be joined by shuffle."""
    found = table.limit(most + 1).toArrow()
    return table.sparkSession.createDataFrame(found) if found.num_rows <= most else table


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, for plans that use it more than once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered_cumsum(
    df: DataFrame,
    order: str,
    sums: dict[str, Column],
    keys: Sequence[str] = (),
    buckets: int | None = None,
    cuts: Sketch | None = None,
    store: bool = False,
) -> DataFrame:
    """One row per (keys, order value), with running sums up to and including it.

    ``sums`` maps a name to a whole-number column to be summed.  The result has the keys,
    ``order`` (double), each name summed over the tied rows, ``cum_<name>``,
    ``total_<name>`` and ``next_value``, the next larger order value of the same keys
    (null at the end).  Rows whose order value is null or NaN are left out.

    Values shared by many rows are collapsed map-side before the shuffle.  Where values
    are mostly distinct only those that fill a bucket on their own are, so a score held by
    a third of all rows costs one row per task, and the other rows, balanced by then, are
    shuffled and sorted once.

    ``df`` is read twice, for bucket totals and for the rows. With ``store`` it is read once: the
    shuffled and collapsed rows are written, both passes read those, and the result has the
    bucket number too. That pays where ``df`` is costly, or where ties or an explosion of columns make its
    rows many.
    """
    keys, names = list(keys), list(sums)
    c = F.col(order).cast("double")
    rows = df.select(
        *keys, (c + F.lit(0.0)).alias(order), *[s.cast("bigint").alias(n) for n, s in sums.items()]
    ).where(F.col(order).isNotNull() & ~F.isnan(order))
    points, rows_per_value = cuts or sketch(rows, order, buckets)
    bucketed = placed = with_bucket(rows, order, points)
    heavy = heavy_values(points)

    def collapse(part: DataFrame) -> DataFrame:
        return part.groupBy(*keys, BUCKET, order).agg(*[F.sum(n).alias(n) for n in names])

    if rows_per_value >= COLLAPSE_FROM:
        placed = collapse(bucketed)
    elif heavy:
        is_heavy = F.expr(f"`{order}` IN ({', '.join(f'{v!r}D' for v in heavy)})")
        placed = bucketed.where(~is_heavy).unionByName(collapse(bucketed.where(is_heavy)))

    inside = Window.partitionBy(*keys, BUCKET).orderBy(order)
    last_of_ties = F.col("_next_in").isNull() | (F.col("_next_in") != F.col(order))
    # the default frame takes in ties; one sort serves all four functions
    detail = placed.select(
        *keys, BUCKET, order,
        *[F.sum(n).over(inside).alias(f"_in_{n}") for n in names],
        F.lead(order).over(inside).alias("_next_in"),
    ).where(last_of_ties).select(
        "*", *[(F.col(f"_in_{n}") - F.lag(f"_in_{n}", 1, 0).over(inside)).alias(n) for n in names]
    )

    if store:
        detail = stored(detail, "ordered")
    if not points and not store:
        whole = Window.partitionBy(*keys, BUCKET)
        return detail.select(
            *keys, order, *names,
            *[F.col(f"_in_{n}").alias(f"cum_{n}") for n in names],
            *[F.sum(n).over(whole).alias(f"total_{n}") for n in names],
            F.col("_next_in").alias("next_value"),
        )

    # at most len(points) + 1 rows per key combination, collapsed before the shuffle
    totals = (detail if store else bucketed).groupBy(*keys, BUCKET).agg(
        *[F.sum(n).alias(f"_s_{n}") for n in names], F.min(order).alias("_first")
    )
    group = keys or [F.lit(0)]
    by_bucket = Window.partitionBy(*group).orderBy(BUCKET)
    below = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    offsets = as_literal(totals.select(
        *keys, BUCKET,
        *[F.coalesce(F.sum(f"_s_{n}").over(below), F.lit(0)).alias(f"_before_{n}") for n in names],
        *[F.sum(f"_s_{n}").over(Window.partitionBy(*group)).alias(f"total_{n}") for n in names],
        F.lead("_first").over(by_bucket).alias("_next_first"),
    ))
    # every bucket has its offsets; a left join infers no extra filter on the bucket number
    same = [detail[k].eqNullSafe(offsets[k]) for k in keys] + [detail[BUCKET] == offsets[BUCKET]]
    return detail.join(offsets, same, "left").select(
        *[detail[k] for k in keys], order, *names,
        *[(F.col(f"_in_{n}") + F.col(f"_before_{n}")).alias(f"cum_{n}") for n in names],
        *[f"total_{n}" for n in names],
        F.coalesce("_next_in", "_next_first").alias("next_value"),
        *([detail[BUCKET]] if store else []),
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    fractions: Sequence[float],
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (keys, fraction, n, quantile).

    The built-in ``percentile`` keeps every distinct value of a group in one buffer.
    Here bucket counts show which bucket each wanted rank lies in, and only the rows of
    those buckets are shuffled and ordered.
    """
    keys = list(keys)
    c = F.col(value).cast("double")
    rows = df.select(*keys, c.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    points = split_points(rows, "_v", buckets)
    rows = with_bucket(rows, "_v", points)

    group = keys or [F.lit(0)]
    below = Window.partitionBy(*group).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy(*keys, BUCKET).agg(F.count("*").alias("_n")).select(
        *keys, BUCKET, "_n",
        F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("n"),
    )
    wanted = (
        cells.withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
        .withColumn("_pos", F.col("fraction") * (F.col("n") - 1))
        .withColumn("_lo", F.floor("_pos"))
        .withColumn("_rank", F.explode(F.array("_lo", F.ceil("_pos"))))
        .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n")))
        .select(*keys, BUCKET, "_before", "n", "fraction", "_rank",
                (F.col("_rank") == F.col("_lo")).alias("_is_lo"),
                (F.col("_pos") - F.col("_lo")).alias("_part"))
        .distinct()
    )
    wanted = as_literal(wanted)
    hit = rows.join(wanted.select(*keys, BUCKET).distinct(), [*keys, BUCKET], "left_semi")
    inside = Window.partitionBy(*keys, BUCKET).orderBy("_v")
    ordered = hit.groupBy(*keys, BUCKET, "_v").agg(F.count("*").alias("_c")).withColumn(
        "_cum", F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    local = F.col("_rank") - F.col("_before")
    picked = ordered.join(wanted, [*keys, BUCKET]).where(
        (local >= F.col("_cum") - F.col("_c")) & (local < F.col("_cum"))
    )
    low = F.max(F.when(F.col("_is_lo"), F.col("_v")))
    high = F.max("_v")
    return picked.groupBy(*keys, "fraction").agg(
        F.max("n").alias("n"),
        (low + (high - low) * F.max("_part")).alias("quantile"),
    )
