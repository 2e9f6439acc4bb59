"""Exact random subsets as a plain filter.

To pick exactly n rows of each class in a reproducible random order, it is enough to
know the n-th smallest digest of the class.  A histogram over the first digits of the
digest finds the cell holding it; while that cell is large, the next digits divide it
again; the last cell is ordered.  The choice then is a comparison with a literal: no
sort and no shuffle of the table, whatever its size and file order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.functions import hash_key, small_table
from riskspark.plans.ordered import as_literal, stored

# Cells per class and level: 16 ** 3, so a task sends at most 4,096 rows per class.
HEX_DIGITS = 3
# A cell up to this size is ordered by one task.
ORDERED_ROWS = 1_000_000
DIGEST_DIGITS = 32
# Digests are hex: these sort after and before all of them.
ALL, NONE = "g", ""


@dataclass(frozen=True)
class HashCut:
    """Rows of the class whose digest is at most ``digest`` belong to the subset."""

    cls: Any
    digest: str
    rows: int
    class_rows: int


def lowest_hash_cuts(
    df: DataFrame,
    key: str,
    sizes: Callable[[dict[Any, int]], dict[Any, int]],
    by: str | None = None,
    seed: int = 42,
) -> list[HashCut]:
    """The cut of every class, where ``sizes`` turns class counts into wanted counts.

    ``key`` must identify a row; the driver holds one cut per value of ``by``.
    """
    spark = df.sparkSession
    cls = F.col(by) if by else F.lit(0)
    rows = df.select(cls.alias("cls"), F.col(key).alias("key"), hash_key(key, seed).alias("digest"))
    kind = rows.schema["cls"].dataType.simpleString()

    def histogram(part: DataFrame, digits: int) -> DataFrame:
        return part.groupBy("cls", F.substring("digest", 1, digits).alias("cell")).agg(F.count("*").alias("n"))

    digits = HEX_DIGITS
    cells = as_literal(histogram(rows, digits))
    # one number per class: the wanted sizes are decided on the driver
    found = cells.groupBy("cls").agg(F.sum("n").alias("n")).collect()
    totals = {r.cls: r.n for r in found}
    wanted = sizes(totals)
    targets = [(c, int(w)) for c, w in wanted.items() if 0 < w < totals[c]]
    cut_cells: list[tuple] = []
    while targets:
        located = _locate(cells, small_table(spark, targets, f"target_cls {kind}, want bigint"))
        cut_cells = [(r.cls, r.cell, r.rest) for r in located]
        if max(r.n for r in located) <= ORDERED_ROWS or digits >= DIGEST_DIGITS:
            break
        part = _inside(rows, spark, cut_cells, kind, digits)
        targets = [(c, rest) for c, _, rest in cut_cells]
        digits += HEX_DIGITS
        cells = as_literal(histogram(part, digits))

    cuts = {}
    if cut_cells and digits >= DIGEST_DIGITS:
        # a cell is one digest, however many rows share it
        cuts = {c: HashCut(c, cell, wanted[c], totals[c]) for c, cell, _ in cut_cells}
    elif cut_cells:
        order = Window.partitionBy("cls").orderBy("digest", "key")
        last = (
            _inside(rows, spark, cut_cells, kind, digits)
            .withColumn("place", F.row_number().over(order)).where(F.col("place") == F.col("rest")).collect()
        )
        cuts = {r.cls: HashCut(r.cls, r.digest, wanted[r.cls], totals[r.cls]) for r in last}
    return [cuts.get(c) or _whole_or_none(c, wanted.get(c, 0), n) for c, n in totals.items()]


def hash_cut_table(
    df: DataFrame, key: str, quotas: Callable[[DataFrame], DataFrame], by: str, seed: int = 42
) -> DataFrame:
    """(cls, digest): the cut of every class as a table, however many classes there are.

    ``quotas`` turns the class totals (cls, n) into (cls, n, want). Cells are refined as in
    ``lowest_hash_cuts``, for all classes at once; the driver sees single numbers only.
    """
    cls = F.col(f"`{by}`")
    rows = df.select(cls.alias("cls"), F.col(f"`{key}`").alias("key"), hash_key(key, seed).alias("digest"))

    def histogram(part: DataFrame, digits: int) -> DataFrame:
        return stored(part.groupBy("cls", F.substring("digest", 1, digits).alias("cell")).agg(F.count("*").alias("n")), "cut-cells")

    def inside(cut: DataFrame, digits: int) -> DataFrame:
        cut = cut.select(F.col("cls").alias("cut_cls"), F.col("cell").alias("cut_cell"), "rest")
        same = F.col("cls").eqNullSafe(F.col("cut_cls")) & (F.substring("digest", 1, digits) == F.col("cut_cell"))
        return rows.join(cut, same).drop("cut_cls", "cut_cell")

    digits = HEX_DIGITS
    cells = histogram(rows, digits)
    wanted = stored(quotas(cells.groupBy("cls").agg(F.sum("n").alias("n"))).select("cls", "n", "want"), "cut-quotas")
    targets = wanted.where("want > 0 AND want < n").select(F.col("cls").alias("target_cls"), "want")
    while True:
        cut = stored(_located(cells, targets).select("cls", "cell", "n", "rest"), "cut-located")
        largest = cut.agg(F.max("n")).first()[0] or 0
        if largest <= ORDERED_ROWS or digits >= DIGEST_DIGITS:
            break
        targets = cut.select(F.col("cls").alias("target_cls"), F.col("rest").alias("want"))
        digits += HEX_DIGITS
        cells = histogram(inside(cut, digits - HEX_DIGITS), digits)
    if digits >= DIGEST_DIGITS:
        last = cut.select("cls", F.col("cell").alias("digest"))  # a cell is one digest
    else:
        order = Window.partitionBy("cls").orderBy("digest", "key")
        last = inside(cut, digits).withColumn("place", F.row_number().over(order)).where("place = rest").select("cls", "digest")
    rest = wanted.where("NOT (want > 0 AND want < n)").select("cls", F.when(F.col("want") > 0, ALL).otherwise(NONE).alias("digest"))
    return stored(last.unionByName(rest), "cuts")


def _located(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """The cell holding the wanted row of each class, and its place inside the cell (``rest``)."""
    below = Window.partitionBy("cls").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # at most 4,096 cells per class
    return (
        cells.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0)))
        .join(targets, F.col("cls").eqNullSafe(F.col("target_cls")))
        .where((F.col("before") < F.col("want")) & (F.col("want") <= F.col("before") + F.col("n")))
        .withColumn("rest", F.col("want") - F.col("before"))
    )


def _locate(cells: DataFrame, targets: DataFrame) -> list:
    return _located(cells, targets).select("cls", "cell", "n", "rest").collect()


def _inside(rows: DataFrame, spark, cut_cells: list[tuple], kind: str, digits: int) -> DataFrame:
    """Rows of the cut cells, with the wanted place; a join with a literal table."""
    cut = small_table(spark, cut_cells, f"cut_cls {kind}, cut_cell string, rest bigint")
    same = F.col("cls").eqNullSafe(F.col("cut_cls")) & (F.substring("digest", 1, digits) == F.col("cut_cell"))
    return rows.join(cut, same).drop("cut_cls", "cut_cell")


def _whole_or_none(cls: Any, want: int, n: int) -> HashCut:
    return HashCut(cls, ALL if want >= n else NONE, n if want >= n else 0, n)


def below_cut(cuts: Sequence[HashCut], key: str, by: str | None = None, seed: int = 42) -> Column:
    """True for the rows the cuts select; a projection, so it also runs on a stream.

    Equal digests mean equal keys, so comparing digests is enough.
    """
    if not by:
        limit = F.lit(cuts[0].digest if cuts else NONE)
    else:
        limit = reduce(
            lambda acc, cut: acc.when(F.col(by).eqNullSafe(F.lit(cut.cls)), F.lit(cut.digest)),
            cuts, F.when(F.lit(False), F.lit(NONE)),
        ).otherwise(F.lit(NONE))
    return hash_key(key, seed) <= limit


def with_cut_table(df: DataFrame, cuts: DataFrame, name: str, key: str, by: str, seed: int = 42) -> DataFrame:
    """``df`` with a boolean column: whether a ``hash_cut_table`` selects the row. The table's size is known to
    Spark, which sends a small one whole and joins a large one by shuffle."""
    table = cuts.select(F.col("cls").alias("_cut_cls"), F.col("digest").alias("_cut_digest"))
    joined = df.join(table, F.col(f"`{by}`").eqNullSafe(F.col("_cut_cls")), "left")
    return joined.withColumn(name, hash_key(key, seed) <= F.coalesce("_cut_digest", F.lit(NONE))).drop("_cut_cls", "_cut_digest")
