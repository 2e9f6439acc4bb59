"""Exact k nearest neighbours without comparing all pairs.

Copies first: of each distinct vector only the k + 1 smallest ids can be anyone's
neighbour (ties go to the smaller id), and one search serves all copies.  The distinct
vectors are assigned to cells around pivots (after Lu, Shen, Chen and Ooi, "Efficient
Processing of k Nearest Neighbor Joins using MapReduce", VLDB 2012), found over two levels: the nearest
top pivot, then the nearest pivot below it, so a point meets about twice the square root of all pivots.
Visits are best first: neighbours in a vector's own block bound its search radius; the few blocks whose cells may
hold the nearest points come next and shrink the radius; only what the triangle inequality still leaves
open is visited last.  Cells are cut into blocks of limited size, and the visitors of a block into
groups of limited size, so no task holds an unbounded group, and at most k + 1 rows per visitor and block come
out.  Every bound is conservative: the result is exact.  Cells, own neighbours and visits are each written
once and read from there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.functions import small_table
from riskspark.plans import as_literal
from riskspark.plans.ordered import stored

SLACK = 1e-9
# Distances held at once, and rows sent on at once, by one task.
CELLS_AT_ONCE = 4_000_000
ROWS_AT_ONCE = 20_000
# Blocks a point visits before its radius is taken anew.
FIRST_VISITS = 4
# Copies of one vector beyond this many are joined back in parts of about this size.
COPIES_PER_PART = 100_000


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b, summed column by column."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        out += diff * diff
    return out


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def _slices(rows: int, width: int) -> Iterator[slice]:
    step = max(1, CELLS_AT_ONCE // max(1, width))
    return (slice(i, i + step) for i in range(0, rows, step))


def nearest_neighbours(
    df: DataFrame,
    key: str,
    vector: Column,
    k: int,
    block_rows: int = 2048,
    max_pivots: int = 1_000_000,
    report: dict[str, int] | None = None,
) -> DataFrame:
    """Rows (id, v, neighbour, nv, rank, distance): the k nearest other points of each point.

    ``vector`` is an array<double> without nulls; ``key`` must be unique. ``report`` is filled with the
    number of distinct vectors and of the blocks they visited beside their own.
    """
    # -0.0 and 0.0 are the same coordinate
    points = df.select(F.col(key).alias("id"), F.transform(vector, lambda x: x + F.lit(0.0)).alias("v"))
    kind = points.schema["id"].dataType.simpleString()
    # the limit on the row number also applies map-side, before the shuffle by vector
    targets = points.withColumn(
        "place", F.row_number().over(Window.partitionBy("v").orderBy("id"))
    ).where(F.col("place") <= k + 1).select("id", "v", (F.col("place") == 1).alias("head"))

    found = _search(targets, kind, k, block_rows, max_pivots, report)
    if found is None:
        return small_table(
            df.sparkSession, [],
            f"id {kind}, v array<double>, neighbour {kind}, nv array<double>, rank int, distance double",
        )
    return _to_all_copies(points, found, k)


class PivotTree:
    """Pivots in two levels: ``tops``, and below each of them the pivots that are nearest to it."""

    def __init__(self, pivots: np.ndarray):
        n = max(1, math.isqrt(len(pivots)))
        self.tops = pivots[:: -(-len(pivots) // n)]
        owner = np.concatenate([_squared(pivots[part], self.tops).argmin(axis=1) for part in _slices(len(pivots), len(self.tops))])
        order = np.argsort(owner, kind="stable")
        self.pivots = pivots[order]
        self.starts = np.searchsorted(owner[order], np.arange(len(self.tops) + 1))
        # a top pivot without pivots of its own holds no points
        self.holders = np.flatnonzero(np.diff(self.starts) > 0)
        self.radius = np.full(len(pivots), -1.0)
        self.blocks = np.zeros(len(pivots), dtype=np.int64)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A cell for each vector, and the distance to its pivot."""
        cell, reach = np.empty(len(vectors), np.int64), np.empty(len(vectors))
        for part in _slices(len(vectors), len(self.holders)):
            top = self.holders[_squared(vectors[part], self.tops[self.holders]).argmin(axis=1)]
            for t in np.unique(top):
                rows = np.flatnonzero(top == t) + part.start
                a, b = self.starts[t], self.starts[t + 1]
                for some in _slices(len(rows), b - a):
                    d2 = _squared(vectors[rows[some]], self.pivots[a:b])
                    near = d2.argmin(axis=1)
                    cell[rows[some]], reach[rows[some]] = a + near, np.sqrt(d2[np.arange(len(d2)), near])
        return cell, reach

    def filled(self, radius: np.ndarray, blocks: np.ndarray) -> None:
        """Take the radius and the number of blocks of each cell, and the distance from each top pivot to what lies below it."""
        self.radius, self.blocks = radius, blocks
        self.top_reach = np.full(len(self.tops), -1.0)
        for t in self.holders:
            a, b = self.starts[t], self.starts[t + 1]
            used = blocks[a:b] > 0
            if used.any():
                far = np.sqrt(_squared(self.tops[t : t + 1], self.pivots[a:b][used])[0]) + radius[a:b][used]
                self.top_reach[t] = far.max()

    @staticmethod
    def _beyond(d2: np.ndarray, pivots: np.ndarray, choice: np.ndarray) -> np.ndarray:
        """How far each vector is at least from the points of each pivot, which are no nearer to any other one of
        ``choice``: its distance to the plane half way to the vector's own nearest pivot."""
        own = choice[d2[:, choice].argmin(axis=1)]
        between = 2.0 * np.sqrt(_squared(pivots, pivots))[own]
        # less what the squares may be rounded by
        ahead = d2 * (1 - 1e-12) - d2[np.arange(len(d2)), own][:, None]
        return np.divide(ahead, between, out=np.zeros_like(ahead), where=between > 0)

    def visits(self, vectors: np.ndarray, bounds: np.ndarray, cell: np.ndarray, block: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(vector, cell, block, least distance) of all blocks but the own one that a point within the bound may lie
        in, nearest first for each vector."""
        slack = SLACK * (1.0 + bounds)
        for part in _slices(len(vectors), len(self.pivots) // max(1, len(self.holders)) * 4 + len(self.tops)):
            v, bound = vectors[part], bounds[part] + slack[part]
            to_top = _squared(v, self.tops)
            beyond = self._beyond(to_top, self.tops, self.holders)
            ball = np.sqrt(to_top) - self.top_reach[None, :]
            open_top = (np.maximum(ball, beyond) <= bound[:, None]) & (self.top_reach >= 0)[None, :]
            found = []
            for t in np.flatnonzero(open_top.any(axis=0)):
                rows = np.flatnonzero(open_top[:, t])
                a, b = self.starts[t], self.starts[t + 1]
                for some in _slices(len(rows), b - a):
                    d2 = _squared(v[rows[some]], self.pivots[a:b])
                    low = np.maximum(np.sqrt(d2) - self.radius[None, a:b], self._beyond(d2, self.pivots[a:b], np.arange(b - a)))
                    low = np.maximum(low, np.maximum(beyond[rows[some], t], 0.0)[:, None])
                    q, c = np.nonzero((low <= bound[rows[some], None]) & (self.blocks[a:b] > 0)[None, :])
                    found.append((rows[some][q], a + c, low[q, c]))
            if not found:
                continue
            q, c, low = map(np.concatenate, zip(*found, strict=True))
            n = self.blocks[c]
            q, c, low = np.repeat(q, n), np.repeat(c, n), np.repeat(low, n)
            blk = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
            other = (c != cell[part][q]) | (blk != block[part][q])
            q, c, low, blk = q[other], c[other], low[other], blk[other]
            order = np.lexsort((blk, c, low, q))
            yield q[order] + part.start, c[order], blk[order], low[order]


def _search(
    targets: DataFrame, kind: str, k: int, block_rows: int, max_pivots: int, report: dict[str, int] | None
) -> DataFrame | None:
    """(v, near): the k + 1 nearest targets of each distinct vector, itself included."""
    heads = targets.where("head")
    rows = heads.count()
    if rows == 0:
        return None
    # expected number of pivots: at most max_pivots, whatever the table size
    wanted = min(max_pivots, math.ceil(rows / block_rows))
    place = F.pmod(F.xxhash64("id", F.lit("pivot")), F.lit(rows))
    sample = heads.where(place < wanted).select("v").collect() if wanted > 1 else []
    sent = heads.sparkSession.sparkContext.broadcast(
        PivotTree(np.array([r.v for r in sample or heads.select("v").limit(1).collect()], dtype=float)))
    row = f"id {kind}, v array<double>, head boolean, cell int"

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cell, reach = sent.value.cells(_matrix(batch["v"]))
                yield batch.assign(cell=cell.astype("int32"), reach=reach)

    assigned = stored(targets.mapInPandas(assign, f"{row}, reach double"), "neighbour-cells")
    tree = sent.value
    # one row per pivot
    radius, blocks = np.full(len(tree.pivots), -1.0), np.zeros(len(tree.pivots), dtype=np.int64)
    for r in assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("reach")).collect():
        radius[r.cell], blocks[r.cell] = r.reach, math.ceil(r.n / block_rows)
    tree.filled(radius, blocks)
    full = heads.sparkSession.sparkContext.broadcast(tree)

    def place_in_block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            block = batch["h"].to_numpy() % full.value.blocks[batch["cell"].to_numpy()]
            yield batch[["id", "v", "head", "cell"]].assign(block=block.astype("int32"))

    home = assigned.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 31))).mapInPandas(place_in_block, f"{row}, block int")

    def nearest(qs: pd.DataFrame, ps: pd.DataFrame) -> tuple[np.ndarray, pd.DataFrame]:
        """The k + 1 closest of ps to each of qs; stable, so equal distances stay in id order."""
        ps = ps.sort_values("id")
        ids, vectors = ps["id"].to_numpy(), ps["v"].to_numpy()
        d2 = _squared(_matrix(qs["v"]), _matrix(ps["v"]))
        order = np.argsort(d2, axis=1, kind="stable")[:, :k + 1]
        q, p = np.repeat(np.arange(len(qs)), order.shape[1]), order.ravel()
        return q, pd.DataFrame({
            "id": qs["id"].to_numpy()[q], "v": qs["v"].to_numpy()[q],
            "neighbour": ids[p], "nv": vectors[p], "d2": d2[q, p],
        })

    empty = {c: pd.Series([], dtype=object) for c in ("id", "v", "neighbour", "nv", "d2")}

    def in_own_block(group: pd.DataFrame) -> pd.DataFrame:
        asking = group[group["head"]]
        if asking.empty:
            return pd.DataFrame({**empty, "cell": [], "block": [], "place": [], "bound": []})
        q, out = nearest(asking, group)
        place = np.arange(len(out)) % (len(out) // len(asking))
        # the vector itself counts: position k is the (k + 1)-th
        bound = np.sqrt(out["d2"].to_numpy().reshape(len(asking), -1)[:, k]) if len(group) > k else np.full(len(asking), np.inf)
        return out.assign(cell=group["cell"].iloc[0], block=group["block"].iloc[0], place=place, bound=bound[q])

    pairs = f"id {kind}, v array<double>, neighbour {kind}, nv array<double>, d2 double"
    own = stored(home.groupBy("cell", "block").applyInPandas(in_own_block, f"{pairs}, cell int, block int, place int, bound double"), "neighbour-own")
    asking = own.where("place = 0").select("id", "v", "cell", "block", "bound")

    def visits(first: bool):
        """The first few blocks each vector visits, or, with a new bound, all others."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                ids, vs = batch["id"].to_numpy(), batch["v"].to_numpy()
                bound, now = (batch[c].to_numpy() for c in ("bound", "bound" if first else "now"))
                slack = SLACK * (1.0 + now)
                for q, cell, block, low in full.value.visits(_matrix(batch["v"]), bound, batch["cell"].to_numpy(), batch["block"].to_numpy()):
                    turn = np.arange(len(q)) - np.searchsorted(q, q)
                    chosen = turn < FIRST_VISITS if first else (turn >= FIRST_VISITS) & (low <= now[q] + slack[q])
                    q, cell, block = q[chosen], cell[chosen], block[chosen]
                    for i in range(0, len(q), ROWS_AT_ONCE):
                        s = slice(i, i + ROWS_AT_ONCE)
                        yield pd.DataFrame({"id": ids[q[s]], "v": vs[q[s]], "cell": cell[s].astype("int32"), "block": block[s].astype("int32")})
        return run

    def closest(qs: pd.DataFrame, ps: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(empty) if qs.empty or ps.empty else nearest(qs, ps)[1]

    def found_by(visit: DataFrame) -> DataFrame:
        # one row per block: how many groups its visitors are split into
        load = visit.groupBy("cell", "block").agg(
            F.ceil(F.count("*") / F.lit(float(block_rows))).cast("int").alias("groups")
        )
        queries = visit.join(load, ["cell", "block"]).withColumn(
            "part", F.pmod(F.xxhash64("id", F.lit("query")), F.col("groups")).cast("int")
        ).drop("groups")
        copies = home.join(load, ["cell", "block"]).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
        ).drop("groups")
        return queries.groupBy("cell", "block", "part").cogroup(
            copies.groupBy("cell", "block", "part")).applyInPandas(closest, pairs)

    visit = f"id {kind}, v array<double>, cell int, block int"
    first = stored(asking.mapInPandas(visits(True), visit), "neighbour-visits")
    best = Window.partitionBy("id").orderBy("d2", "neighbour")

    def kept(candidates: DataFrame) -> DataFrame:
        return candidates.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place")

    near = stored(kept(own.select("id", "v", "neighbour", "nv", "d2").unionByName(found_by(first))), "neighbour-near")
    now = near.groupBy("id").agg(F.when(F.count("*") > k, F.sqrt(F.max("d2"))).otherwise(F.lit(float("inf"))).alias("now"))
    # a vector that had fewer blocks to visit than its first few has seen them all
    full_turns = first.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") >= FIRST_VISITS).select("id")
    later = stored(asking.join(full_turns, "id", "left_semi").join(now, "id").mapInPandas(visits(False), visit), "neighbour-later")
    if report is not None:
        report.update(vectors=rows, first_visits=first.count(), later_visits=later.count())
    return (
        kept(near.unionByName(found_by(later)))
        # at most k + 1 entries per vector
        .groupBy("id", "v").agg(F.sort_array(F.collect_list(F.struct("d2", "neighbour", "nv"))).alias("near"))
        .select("v", "near")
    )


def _to_all_copies(points: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Give every point its vector's neighbours, without itself.

    Vectors with very many copies are spread over several join keys; there are at most
    rows / COPIES_PER_PART of them.
    """
    heavy = as_literal(
        points.groupBy("v").agg(F.ceil(F.count("*") / F.lit(float(COPIES_PER_PART))).cast("int").alias("parts"))
        .where("parts > 1")
    )
    parts = F.coalesce("parts", F.lit(1))
    members = points.join(heavy, "v", "left").withColumn(
        "part", F.pmod(F.xxhash64("id"), parts).cast("int")
    ).drop("parts")
    answers = found.join(heavy, "v", "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), parts - 1))
    ).drop("parts")
    others = F.slice(F.filter("near", lambda n: n["neighbour"] != F.col("id")), 1, k)
    return members.join(answers, ["v", "part"]).select("id", "v", F.posexplode(others).alias("i", "n")).select(
        "id", "v", F.col("n.neighbour").alias("neighbour"), F.col("n.nv").alias("nv"),
        (F.col("i") + 1).alias("rank"), F.sqrt("n.d2").alias("distance"),
    )
