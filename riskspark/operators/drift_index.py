"""A kept distribution of a reference, against which small tables are compared without reading the
reference again.

The index holds every distinct value of each numeric feature with its rows and the rows up to it, in
cells between fixed cut points, one folder per feature and cell, and one summary row per cell. A
table that is compared touches the cells its values fall in. In all others its own
distribution is flat, and the summary says how far apart the two are there, unless the reference
crosses the flat part inside the cell; that happens in one cell between two touched ones at most.
So only touched and crossed cells are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskspark.config import DriftConfig
from riskspark.functions import small_table
from riskspark.operators.drift import MIN_STD, category_counts, distances_of_counts, verdicts
from riskspark.plans import Sketch, ordered_cumsum, sketch, with_bucket
from riskspark.plans.ordered import BUCKET, stored

# Rows of a cell at most, about, and cells of a feature at least: what a small table has to read of one touched cell.
CELL_ROWS = 1_000_000
LEAST_CELLS = 64


class DriftIndex(NamedTuple):
    """An index on disk: cut points that all numeric features share, and the reference's rows."""

    spark: SparkSession
    path: str
    points: list[float]
    numeric: list[str]
    categorical: list[str]
    rows: int

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")


def _long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])))


def build_index(
    reference: DataFrame, path: str, numeric: Sequence[str], categorical: Sequence[str], cells: int | None = None
) -> DriftIndex:
    """Write the index of ``reference`` to ``path``; an index that stands there already is opened.

    Cells are cut at quantiles of a sample, the same for all features; they only balance the work.
    """
    spark = reference.sparkSession
    try:
        return open_index(spark, path)
    except FileNotFoundError:
        pass
    rows = reference.count()
    wanted = cells or max(LEAST_CELLS, rows * len(numeric) // CELL_ROWS + 1)
    sampled = sketch(_long(reference, numeric), "value", wanted, share=min(1.0, max(0.01, 200_000 / max(rows, 1))))
    points = sorted(set(sampled.points))
    values = ordered_cumsum(_long(reference, numeric), "value", {"n": F.lit(1)}, ["feature"],
                            cuts=Sketch(points, sampled.rows_per_value), store=True)
    low, high = _edges(points, F.col("cell"))
    values = values.withColumnRenamed(BUCKET, "cell").withColumns({"low": low, "high": high})
    inside = Window.partitionBy("feature", "cell").orderBy("value")
    until = F.coalesce(F.lead("value").over(inside), "high", "value")
    values = values.withColumn("until", until)
    values.select("feature", "cell", "value", "n", "cum_n").write.partitionBy("feature", "cell").mode("overwrite").parquet(f"{path}/values")

    share = F.col("cum_n") / F.col("total_n")
    # the area under the share from the cell's low edge to its high one
    part = values.groupBy("feature", "cell").agg(
        F.sum("n").alias("n"), F.max("total_n").alias("total"), F.max("cum_n").alias("cum"), F.min("value").alias("first"),
        F.max("value").alias("last"), F.sum(share * (F.col("until") - F.col("value"))).alias("area"),
        F.sum(F.col("value") * F.col("n")).alias("sum"))
    means = part.groupBy("feature").agg((F.sum("sum") / F.sum("n")).alias("mean"))
    off = F.col("value") - F.col("mean")
    spread = values.join(means, "feature").groupBy("feature").agg(F.sqrt(F.sum(off * off * F.col("n")) / F.sum("n")).alias("std"))
    # one row per feature and cell, empty cells too
    grid = small_table(spark, [(f, c) for f in numeric for c in range(len(points) + 1)], "feature string, cell int")
    before = Window.partitionBy("feature").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    full = grid.join(part, ["feature", "cell"], "left").withColumns({
        "before": F.coalesce(F.max("cum").over(before), F.lit(0)),
        "total": F.max("total").over(Window.partitionBy("feature"))})
    start = F.col("before") / F.col("total")
    low, high = _edges(points, F.col("cell"))
    full = full.withColumns({"low": low, "high": high})
    # nothing lies below the lowest value or above the highest
    full = full.withColumns({
        "from": F.coalesce("low", "first"), "to": F.coalesce("high", "last")})
    full = full.withColumns({
        "area": F.coalesce(F.col("area"), F.lit(0.0)) + start * F.coalesce(F.coalesce("first", "to") - F.col("from"), F.lit(0.0)),
        "length": F.coalesce(F.col("to") - F.col("from"), F.lit(0.0)),
        "start": start, "end": F.coalesce(F.col("cum") / F.col("total"), start)})
    full.join(spread, "feature", "left").select(
        "feature", "cell", "low", "high", F.coalesce("n", F.lit(0)).alias("n"), "before", "total", "area", "length", "start", "end", "std"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    if categorical:
        category_counts(reference, reference.limit(0), categorical).select("feature", "category", "ref").write.mode(
            "overwrite").parquet(f"{path}/categories")
    # written last: where it stands the index is whole
    small_table(spark, [(points, list(numeric), list(categorical), rows)],
                "points array<double>, numeric array<string>, categorical array<string>, rows bigint").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/index")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> DriftIndex:
    """The index at ``path``; ``FileNotFoundError`` where none was finished."""
    home = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/index/_SUCCESS")
    if not home.getFileSystem(spark._jsc.hadoopConfiguration()).exists(home):
        raise FileNotFoundError(f"no drift index at {path}")
    r = spark.read.parquet(f"{path}/index").first()
    return DriftIndex(spark, path, list(r.points), list(r.numeric), list(r.categorical), r.rows)


def _edges(points: Sequence[float], cell: Column) -> tuple[Column, Column]:
    """Low and high edge of a cell, null where it is open."""
    if not points:
        return F.lit(None).cast("double"), F.lit(None).cast("double")
    table = F.array(*[F.lit(float(p)) for p in points])
    return F.try_element_at(table, F.when(cell > 0, cell)), F.try_element_at(table, F.when(cell < len(points), cell + 1))


class Touched(NamedTuple):
    """The cells a comparison reads, and what it found."""

    cells: list[tuple[str, int]]
    distances: DataFrame


def compared(index: DriftIndex, current: DataFrame) -> Touched:
    """``numeric_distances`` of the reference and ``current``, from the index."""
    spark, names = index.spark, index.numeric
    rows = with_bucket(_long(current, names).where("value IS NOT NULL AND NOT isnan(value)"), "value", index.points)
    # equal values once; written, because both the cells and the details need them
    mine = stored(rows.groupBy("feature", F.col(BUCKET).alias("cell"), (F.col("value") + F.lit(0.0)).alias("value")).agg(
        F.count("*").alias("cur")), "drift-batch")
    per_cell = mine.groupBy("feature", "cell").agg(F.sum("cur").alias("cur"))
    before = Window.partitionBy("feature").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    # one row per feature and cell, however many rows either side has
    cells = index._read("cells").join(per_cell, ["feature", "cell"], "left").withColumns({
        "cur": F.coalesce("cur", F.lit(0)), "cur_total": F.sum("cur").over(whole),
        "cur_before": F.coalesce(F.sum("cur").over(before), F.lit(0))})
    flat = F.col("cur_before") / F.col("cur_total")
    crossed = (F.col("start") < flat) & (flat < F.col("end"))
    cells = stored(cells.where("cur_total > 0 AND total > 0").withColumns({"flat": flat, "read": (F.col("cur") > 0) | crossed}), "drift-cells")
    read = sorted((r.feature, r.cell) for r in cells.where("read").select("feature", "cell").collect())

    untouched = cells.where("NOT read").select(
        "feature", F.abs(F.col("area") - F.col("flat") * F.col("length")).alias("distance"),
        F.greatest(F.abs(F.col("start") - F.col("flat")), F.abs(F.col("end") - F.col("flat"))).alias("gap"))
    picked = small_table(spark, read, "feature string, cell int")
    wanted = F.lit(False)
    for f in names:
        of = [c for g, c in read if g == f]
        if of:
            wanted = wanted | ((F.col("feature") == f) & F.col("cell").isin(of))
    kept = index._read("values").where(wanted).select(
        "feature", F.col("cell").cast("int").alias("cell"), "value", F.col("n").alias("ref"), F.lit(0).cast("long").alias("cur"))
    ends = cells.where("read").select("feature", "cell", "low", "high", "before", "total", "cur_before", "cur_total")
    # the share at a cell's low edge counts from there to its first value
    edges = ends.where("low IS NOT NULL").select(
        "feature", "cell", F.col("low").alias("value"), F.lit(0).cast("long").alias("ref"), F.lit(0).cast("long").alias("cur"))
    both = kept.unionByName(mine.join(picked, ["feature", "cell"], "left_semi").select(
        "feature", "cell", "value", F.lit(0).cast("long").alias("ref"), "cur")).unionByName(edges)
    tied = both.groupBy("feature", "cell", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    inside = Window.partitionBy("feature", "cell").orderBy("value")
    detail = tied.withColumns({
        "in_ref": F.sum("ref").over(inside), "in_cur": F.sum("cur").over(inside), "next": F.lead("value").over(inside)
    }).join(ends, ["feature", "cell"])
    gap = F.abs((F.col("before") + F.col("in_ref")) / F.col("total") - (F.col("cur_before") + F.col("in_cur")) / F.col("cur_total"))
    until = F.coalesce("next", "high", "value")
    touched = detail.select("feature", (gap * (until - F.col("value"))).alias("distance"), gap.alias("gap"))
    totals = cells.groupBy("feature").agg(
        F.max("total").alias("reference_rows"), F.max("cur_total").alias("current_rows"), F.max("std").alias("std"))
    distances = untouched.unionByName(touched).groupBy("feature").agg(
        F.sum("distance").alias("wasserstein"), F.max("gap").alias("ks")).join(totals, "feature").select(
        "feature", "reference_rows", "current_rows", "wasserstein", "ks", "std",
        (F.col("wasserstein") / F.greatest(F.col("std"), F.lit(MIN_STD))).alias("normed_wasserstein"))
    return Touched(read, distances)


def category_distances(index: DriftIndex, current: DataFrame, log_base: float) -> DataFrame:
    """``categorical_distances`` from the kept counts, one row per category."""
    names = index.categorical
    entries = F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("category")) for f in names]))
    mine = current.select(entries).groupBy("feature", "category").agg(F.count("*").alias("cur"))
    kept = index._read("categories").select("feature", "category", "ref", F.lit(0).cast("long").alias("cur"))
    counts = kept.unionByName(mine.select("feature", "category", F.lit(0).cast("long").alias("ref"), "cur")).groupBy(
        "feature", "category").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    totals = counts.groupBy("feature").agg(F.sum("ref").alias("total_ref"), F.sum("cur").alias("total_cur"))
    # one row per feature, however many categories
    return distances_of_counts(counts.join(F.broadcast(totals), "feature"), log_base)


def index_drift(index: DriftIndex, current: DataFrame, config: DriftConfig = DriftConfig(), method: str = "distance") -> DataFrame:
    """``feature_drift`` of the indexed reference and ``current``."""
    return verdicts(compared(index, current).distances, category_distances(index, current, config.log_base), config, method)
