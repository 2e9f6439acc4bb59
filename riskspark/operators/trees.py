"""Regression trees for boosting, grown over all rows by sums per node, column and bin.

Rows stay where they are: a task keeps its rows, their bins and running margins, in files of its executor's
local folder, and only sums of Newton steps per node, column and bin travel. A level of a tree is one pass;
the pass that begins a tree also moves the margins by the tree before it. Of two children the one with fewer
rows is summed up, and the other is what is left of their parent. Files lost with their executor are made
again from the written table and the trees so far. Bins are found once, over all rows.
"""

from __future__ import annotations

import math
import os
import pickle
import random
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bins of a column, at most; they are numbered in one byte.
BINS = 64
#: Rank error of the quantiles between bins, as a share of the rows.
RANK_ERROR = 0.001
#: Rows that make it worth a task of their own in every pass, while there are cores for more tasks.
TASK_ROWS = 100_000
#: Rows that a task works on at a time, which fit a core's cache, and rows that it counts at a time.
PIECE, COUNTED = 1 << 16, 1 << 18
#: Cells of columns that are counted together, at most, in trees up to this depth; every node of a level has so many.
JOINT_CELLS, JOINT_DEPTH = 4096, 6
#: Bytes of sums that the driver adds up itself; beyond, tasks add them up first.
DRIVER_BYTES = 32_000_000
#: Trees that one job moves lost rows by when they are made again.
KEPT_EVERY = 20
#: Times a pass is run again where a task was sent away from its rows, and times rows are made again for a tree.
TRIES = 5
#: What is left of a parent is taken while it has this share of the weight that was summed up, as rounding is relative to that.
LEAST_LEFT = 1e-6
#: A split must lower the sum of squares by more than this share of it, or it is rounding.
LEAST_GAIN = 1e-12
COUNT, WEIGHT, FIRST, SECOND = range(4)  # rows, weight, weighted sum of steps, and of their squares


@dataclass(frozen=True)
class Sampling:
    """Which rows a tree sees: a hash of row number, seed and round, so a recomputed task sees the same."""

    seed: int
    turn: int
    share: float

    def seen(self, row: np.ndarray) -> np.ndarray:
        h = row.astype(np.uint64) + np.uint64((self.seed * 1_000_003 + self.turn + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (h >> np.uint64(44)).astype(np.int64) < int(self.share * (1 << 20))


class Tree:
    """Nodes by place: the root is 1, the children of ``i`` are ``2 i`` and ``2 i + 1``."""

    def __init__(self, depth: int):
        self.depth, places = depth, 2 << depth
        self.feature = np.full(places, -1, np.int16)  # -1: a leaf
        self.cut = np.zeros(places, np.int16)         # the last bin that goes left
        self.total = np.zeros((places, 4))
        self.gain = np.zeros(places)
        self.value = np.zeros(places)

    def deepest(self) -> int:
        """The last level with a split; 0 without any."""
        return max(int(np.flatnonzero(self.feature >= 0).max(initial=1)).bit_length() - 1, 0)

    def split(self, sums: np.ndarray, nodes: Sequence[int], columns: Sequence[int]) -> list[int]:
        """Give each node its best split, if one lowers the sum of squares; the children that may split again."""
        whole = sums[:, :, 0].sum(axis=2)
        left = np.cumsum(sums, axis=3)[..., :-1]
        # summed from the other end, so that no rows are exactly none
        right = np.flip(np.cumsum(np.flip(sums, axis=3), axis=3), axis=3)[..., 1:]
        both = (left[COUNT] > 0) & (right[COUNT] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            less = left[FIRST] ** 2 / left[WEIGHT] + right[FIRST] ** 2 / right[WEIGHT] - (
                whole[FIRST] ** 2 / whole[WEIGHT])[:, None, None]
        less = np.where(both, less, -np.inf).reshape(len(nodes), -1)
        opened = []
        for i, node in enumerate(nodes):
            self.total[node], self.value[node] = whole[:, i], whole[FIRST, i] / whole[WEIGHT, i]
            best = int(less[i].argmax()) if less.shape[1] else 0
            if not less.shape[1] or less[i, best] <= LEAST_GAIN * whole[SECOND, i]:
                continue
            column, cut = divmod(best, left.shape[3])
            self.feature[node], self.cut[node], self.gain[node] = columns[column], cut, less[i, best] / whole[WEIGHT, i]
            for child, side in ((2 * node, left), (2 * node + 1, right)):
                self.total[child] = side[:, i, column, cut]
                self.value[child] = self.total[child, FIRST] / self.total[child, WEIGHT]
                if self.total[child, COUNT] > 1:
                    opened.append(child)
        return opened


@dataclass
class Block:
    """Rows on their way to their task: ``bins`` has a row per column."""

    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray
    row: np.ndarray


@lru_cache(maxsize=1024)
def _bin_of_cell(shape: tuple[int, ...], place: int) -> np.ndarray:
    return np.unravel_index(np.arange(math.prod(shape)), shape)[place].astype(np.uint8)


@dataclass(frozen=True)
class Layout:
    """Columns in groups; the bins of a group's columns make one number, its cell."""

    groups: tuple[tuple[int, ...], ...]
    bins: tuple[int, ...]  # per column

    @staticmethod
    def of(bins: Sequence[int], cells: int) -> Layout:
        groups: list[list[int]] = []
        for column in sorted(range(len(bins)), key=lambda c: -bins[c]):
            room = [g for g in groups if math.prod(bins[c] for c in g) * bins[column] <= cells]
            if room:
                room[0].append(column)
            else:
                groups.append([column])
        return Layout(tuple(map(tuple, groups)), tuple(bins))

    def shape(self, group: int) -> tuple[int, ...]:
        return tuple(self.bins[c] for c in self.groups[group])

    def cells(self, group: int) -> int:
        return math.prod(self.shape(group))

    def keys(self, bins: np.ndarray) -> np.ndarray:
        """The cell of every row (a column of ``bins``) in every group."""
        return np.stack([np.ravel_multi_index(tuple(bins[list(g)].astype(np.intp)), self.shape(i))
                         for i, g in enumerate(self.groups)], axis=1).astype(np.uint16)

    def ways(self, tree: Tree, level: int) -> tuple[np.ndarray, ...] | None:
        """How rows go on from a level, if any node of it is split. Per place: the group of its column, and where its row of the
        third array begins; per cell of the group: whether it goes right; per place, twice: the places it leads to."""
        nodes = [n for n in range(1 << level, 2 << level) if tree.feature[n] >= 0]
        if not nodes:
            return None
        places, width = len(tree.feature), max(map(self.cells, range(len(self.groups))))
        group, start = np.zeros((2, places), np.intp)
        right = np.zeros((1 + len(nodes), width), np.uint8)  # the first row is for all that stay
        to = np.repeat(np.arange(places), 2)
        for i, node in enumerate(nodes, 1):
            group[node], place = next((g, c.index(tree.feature[node])) for g, c in enumerate(self.groups) if tree.feature[node] in c)
            bins = _bin_of_cell(self.shape(group[node]), place)
            start[node], right[i, : len(bins)] = i * width, bins > tree.cut[node]
            to[2 * node : 2 * node + 2] = 2 * node, 2 * node + 1
        return group, start, right.reshape(-1), to

@dataclass(frozen=True)
class Step:
    """One pass: the level of ``tree``, the ``turn``-th, of whose ``nodes`` sums are wanted; ``last`` came before it."""

    turn: int
    level: int
    tree: Tree
    last: Tree | None
    nodes: Sequence[int]
    columns: Sequence[int]
    sampling: Sampling
    rate: float
    largest: float


class Rows:
    """Rows of a task, in files of a folder, so that whichever Python worker of the executor gets the task has them.

    Margins and places exist twice: a tree begins by reading what the one before it left and writing the other, and ``done``
    names the tree that was begun, and which of both it has. So a pass that is run again gives the same.
    """

    KINDS = {"y": "f8", "w": "f8", "row": "i8", "seen": "?", "weight": "f8", "step": "f8", "margin0": "f8", "margin1": "f8",
             "at0": "u4", "at1": "u4", "done": "i8", "keys": "u2"}
    GIVEN = ("y", "w", "row")

    def __init__(self, folder: str, layout: Layout):
        self.layout = layout
        for name, kind in self.KINDS.items():
            setattr(self, name, np.asarray(np.memmap(f"{folder}/{name}", kind, "r+")))
        self.margin, self.at = (self.margin0, self.margin1), (self.at0, self.at1)
        self.keys = self.keys.reshape(len(layout.groups), -1)

    @classmethod
    def written(cls, blocks: Iterator[Block], layout: Layout) -> Iterator[str]:
        """The folder with the rows of ``blocks``, if there are any."""
        local = [d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(d)]
        folder, size = tempfile.mkdtemp(prefix="boosting-", dir=random.choice(local) if local else None), 0
        files = {n: open(f"{folder}/{n}", "wb") for n in ("given", *cls.GIVEN)}
        for b in blocks:
            size += len(b.y)
            files["given"].write(layout.keys(b.bins).tobytes())
            for n in cls.GIVEN:
                files[n].write(getattr(b, n).astype(cls.KINDS[n]).tobytes())
        for f in files.values():
            f.close()
        if not size:
            shutil.rmtree(folder)
            return
        lengths = {"done": 1, "keys": size * len(layout.groups)}
        for n, kind in cls.KINDS.items():
            if n not in cls.GIVEN:  # zeros
                with open(f"{folder}/{n}", "wb") as f:
                    f.truncate(np.dtype(kind).itemsize * lengths.get(n, size))
        rows, given = cls(folder, layout), np.memmap(f"{folder}/given", "u2", "r").reshape(size, -1)
        for p in rows.pieces():
            rows.keys[:, p] = given[p].T
        os.remove(f"{folder}/given")
        yield folder

    def pieces(self) -> Iterator[slice]:
        return (slice(low, min(low + PIECE, len(self.y))) for low in range(0, len(self.y), PIECE))

    def begun(self) -> tuple[int, int]:
        """The tree begun last, -1 for none, and which margins and places it has."""
        turn, which = divmod(int(self.done[0]), 2)
        return turn - 1, which

    def down(self, p: slice, at: np.ndarray, ways: tuple[np.ndarray, ...] | None) -> np.ndarray:
        """The places that rows go on to; those that went before are not at the level any more, and stay."""
        if ways is None:
            return at
        group, start, right, to = ways
        cell = self.keys.reshape(-1).take(group.take(at) * self.keys.shape[1] + np.arange(p.start, p.stop))
        return to.take(2 * at.astype(np.intp) + right.take(start.take(at) + cell))

    def moved(self, turn: int, trees: Sequence[Tree], last: Tree | None, rate: float) -> bool:
        """Go on from the tree ``last`` through ``trees``, of which ``turn`` is the first."""
        begun, which = self.begun()
        if begun != turn - 1:
            return begun == turn + len(trees) - 1
        ways = [[self.layout.ways(tree, level) for level in range(tree.depth)] for tree in trees]
        for p in self.pieces():
            margin = self.margin[which][p] + (rate * last.value.take(self.at[which][p]) if last else 0.0)
            for i, tree in enumerate(trees):
                if i:
                    margin += rate * trees[i - 1].value.take(at)
                at = np.ones(len(margin), np.intp)
                for way in ways[i]:
                    at = self.down(p, at, way)
            self.margin[1 - which][p], self.at[1 - which][p] = margin, at
        self.done[0] = 2 * (turn + len(trees)) + 1 - which
        return True

    def begin(self, p: slice, old: int, ways: tuple[np.ndarray, ...] | None, step: Step) -> None:
        """Margins moved by the last tree, all rows at the root, and their Newton steps."""
        margin = self.margin[old][p]
        if step.last:
            margin = margin + step.rate * step.last.value.take(self.down(p, self.at[old][p], ways))
        self.margin[1 - old][p], self.at[1 - old][p] = margin, 1
        self.seen[p] = step.sampling.seen(self.row[p])
        chance = 1 / (1 + np.exp(-margin))
        curve = np.maximum(chance * (1 - chance), 1e-12)
        self.weight[p] = self.w[p] * curve
        self.step[p] = np.clip((self.y[p] - chance) / curve, -step.largest, step.largest)

    def sums(self, step: Step) -> np.ndarray | None:
        """Rows, weight, steps and their squares per node, column and bin; None where these rows are not at this step."""
        begun, which = self.begun()
        if begun != step.turn:
            if step.level or begun != step.turn - 1:
                return None
            which = 1 - which
        before, level = (step.tree, step.level - 1) if step.level else (step.last, step.last.deepest() if step.last else 0)
        ways = self.layout.ways(before, level) if before else None
        slot = np.full(len(step.tree.feature), -1, np.intp)
        slot[list(step.nodes)] = np.arange(len(step.nodes))
        count = Counted(self.layout, len(step.nodes), step.columns)
        for p in self.pieces():
            if step.level:
                at = self.down(p, self.at[which][p], ways)
                self.at[which][p] = at
                node = slot.take(at)
                used = np.flatnonzero(self.seen[p] & (node >= 0))
                node = node.take(used)
            else:
                self.begin(p, 1 - which, ways, step)
                used = np.flatnonzero(self.seen[p])
                node = None
            count.add(node, self.weight[p].take(used), self.step[p].take(used), [k[p].take(used) for k in self.keys])
        if not step.level:
            self.done[0] = 2 * (step.turn + 1) + which
        return count.sums()


class Counted:
    """Sums per node, column and bin of rows that come in pieces."""

    def __init__(self, layout: Layout, nodes: int, columns: Sequence[int]):
        self.layout, self.nodes, self.columns = layout, nodes, list(columns)
        self.groups = [g for g, members in enumerate(layout.groups) if set(members) & set(columns)]
        self.found = {g: np.zeros((4, nodes * layout.cells(g))) for g in self.groups}
        self.kept: list[tuple] = []
        self.rows = 0

    def add(self, node: np.ndarray | None, weight: np.ndarray, step: np.ndarray, keys: list[np.ndarray]) -> None:
        """``node`` may be missing if there is one."""
        self.kept.append((weight, step, *keys, *([] if node is None else [node])))
        self.rows += len(weight)
        if self.rows >= COUNTED:
            self.count()

    def count(self) -> None:
        if not self.kept:
            return
        weight, step, *keys = (np.concatenate(part) for part in zip(*self.kept))
        node = keys.pop() if len(keys) > len(self.layout.groups) else None
        self.kept, self.rows = [], 0
        first = weight * step
        terms = (None, weight, first, first * step)
        for g in self.groups:
            cell = keys[g].astype(np.intp)
            if node is not None:
                cell += node * self.layout.cells(g)
            for into, term in zip(self.found[g], terms):
                into += np.bincount(cell, term, len(into))

    def sums(self) -> np.ndarray:
        self.count()
        out = np.zeros((4, self.nodes, len(self.columns), BINS))
        for g in self.groups:
            joint = self.found[g].reshape(4, self.nodes, *self.layout.shape(g))
            for i, column in enumerate(self.layout.groups[g]):
                if column in self.columns:
                    others = tuple(2 + k for k in range(len(self.layout.groups[g])) if k != i)
                    out[:, :, self.columns.index(column), : self.layout.bins[column]] = joint.sum(axis=others)
        return out


def _at_rows(folder: str, layout: Layout, work: Callable[[Rows], object]):
    try:
        rows = Rows(folder, layout)
    except FileNotFoundError:
        return None
    return work(rows)


def cut_points(table: DataFrame, size: int) -> list[np.ndarray]:
    """Per column of ``x`` the bounds between bins: halfway between neighbouring values where a column has at most
    ``BINS`` of them, else between neighbouring quantiles of all rows, the least and the greatest value among them."""
    names = [f"x{i}" for i in range(size)]
    values = table.select(*[F.col("x")[i].alias(n) for i, n in enumerate(names)])
    kinds = values.agg(*[F.approx_count_distinct(n).alias(n) for n in names]).first()
    few = [n for n in names if kinds[n] <= BINS]
    # at most about BINS values each
    found = dict(zip(few, values.agg(*[F.collect_set(n) for n in few]).first())) if few else {}
    many = [n for n in names if len(found.get(n, range(BINS + 1))) > BINS]
    ranks = [i / (BINS - 1) for i in range(BINS)]
    found |= dict(zip(many, values.approxQuantile(many, ranks, RANK_ERROR))) if many else {}
    cuts = []
    for n in names:
        v = np.unique(np.array(found[n], float))
        middle = v[:-1] / 2 + v[1:] / 2
        # a bound parts its two values even where rounding spoils the middle
        cuts.append(np.where((middle >= v[:-1]) & (middle < v[1:]), middle, v[:-1]))
    return cuts


def _block_bytes(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            y, w, row = (b.column(n).to_numpy(zero_copy_only=False) for n in ("y", "w", "row"))
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            if not np.isfinite(x).all():
                raise ValueError("feature values must not be null, NaN or infinite")
            if not (np.isfinite(y).all() and np.isfinite(w).all() and (w >= 0).all()):
                raise ValueError("labels and weights must be numbers, and weights not negative")
            bins = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)]).astype(np.uint8)
            block = pickle.dumps(Block(bins, y, w, row), pickle.HIGHEST_PROTOCOL)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])

    return run


def blocks(table: DataFrame, tasks: int, cuts: list[np.ndarray]) -> RDD:
    """(x, y, w, row) dealt out over so many tasks."""
    packed = table.mapInArrow(_block_bytes(cuts), "block binary").repartition(tasks)
    return packed.rdd.map(lambda r: pickle.loads(r.block))


class _Lost(Exception):
    """Rows are not where they were."""


def _plus(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
    return None if a is None or b is None else a + b


def _added(held: RDD, layout: Layout, step: Step) -> np.ndarray:
    size = 4 * len(step.nodes) * len(step.columns) * BINS
    parts = held.map(lambda folder: _at_rows(folder, layout, lambda rows: rows.sums(step)))
    for turn in range(TRIES):
        if parts.getNumPartitions() * size * 8 > DRIVER_BYTES:
            found = parts.treeReduce(_plus)
        else:
            found = None
            for i, part in enumerate(parts.collect()):
                found = _plus(found, part) if i else part
        if found is not None:
            return found
        time.sleep(turn)  # a task that ran elsewhere, as its executor was busy, goes back
    raise _Lost


def _left(parent: np.ndarray, other: np.ndarray, largest: float) -> np.ndarray:
    """Sums of the parent without those of the other child; what rounding leaves of no rows is nothing."""
    left = parent - other
    left[:, left[COUNT] <= 0] = 0
    left[WEIGHT] = np.maximum(left[WEIGHT], np.abs(left[FIRST]) / largest)
    left[SECOND] = np.maximum(left[SECOND], 0)
    return left


def _grown(turn: int, columns: Sequence[int], depth: int, largest: float, added: Callable[[int, Tree, list[int]], np.ndarray]) -> Tree:
    """A tree by sums of the nodes that ``added`` gives."""
    tree, nodes = Tree(depth), [1]
    known: dict[int, np.ndarray] = {}  # sums of the level above
    summed = {}                        # the weight that was summed up for them
    for level in range(depth):
        wanted, rest = [], {}
        for parent in sorted({n // 2 for n in nodes}):
            few, many = sorted((2 * parent, 2 * parent + 1), key=lambda n: tree.total[n, COUNT])
            if level and many in nodes and tree.total[many, WEIGHT] >= LEAST_LEFT * summed[parent]:
                wanted.append(few)
                rest[many] = few
            else:
                wanted += [n for n in (few, many) if n in nodes]
        found = added(level, tree, wanted)
        sums = {n: found[:, i] for i, n in enumerate(wanted)}
        weights = {n: s[WEIGHT, 0].sum() for n, s in sums.items()}
        for n, other in rest.items():
            sums[n], weights[n] = _left(known[n // 2], sums[other], largest), summed[n // 2]
        nodes, known, summed = tree.split(np.stack([sums[n] for n in nodes], axis=1), nodes, columns), sums, weights
        if not nodes:
            break
    return tree


def grow(table: DataFrame, rows: int, cuts: list[np.ndarray], drawn: Sequence[Sequence[int]], depth: int, rate: float,
         share: float, seed: int, largest: float) -> Iterator[Tree]:
    """One tree per entry of ``drawn``, the columns it may split, each fitted to the steps the trees before it leave."""
    tasks = max(1, min(math.ceil(rows / TASK_ROWS), table.sparkSession.sparkContext.defaultParallelism))
    layout = Layout.of([len(c) + 1 for c in cuts], JOINT_CELLS if depth <= JOINT_DEPTH else BINS)
    source, done = blocks(table, tasks, cuts), []

    def made() -> RDD:
        """The folders; where they are is where their rows are."""
        return source.mapPartitions(lambda part: Rows.written(part, layout)).persist(StorageLevel.MEMORY_AND_DISK)

    def again() -> RDD:
        found = made()
        for turn in range(0, len(done), KEPT_EVERY):
            some, last = done[turn : turn + KEPT_EVERY], done[turn - 1] if turn else None
            found.map(lambda folder, some=some, last=last, turn=turn: _at_rows(
                folder, layout, lambda rows: rows.moved(turn, some, last, rate))).count()
        return found

    def dropped(found: RDD) -> None:
        found.foreach(lambda folder: shutil.rmtree(folder, ignore_errors=True))
        found.unpersist()

    held = made()
    try:
        for turn, columns in enumerate(drawn):
            for left in reversed(range(TRIES)):
                try:
                    tree = _grown(turn, columns, depth, largest, lambda level, tree, nodes: _added(held, layout, Step(
                        turn, level, tree, done[-1] if done else None, nodes, columns, Sampling(seed, turn, share), rate, largest)))
                    break
                except _Lost:
                    if not left:
                        raise RuntimeError("executors lose the rows of a boosted model again and again") from None
                    dropped(held)
                    held = again()
            done.append(tree)
            yield tree
    finally:
        dropped(held)


def as_model(spark: SparkSession, tree: Tree, cuts: list[np.ndarray]):
    """The tree as MLlib's regression model, in the JVM."""
    jvm = spark.sparkContext._jvm
    node, impurity = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity
    leaf, inner, bound = node.LeafNode, node.InternalNode, node.ContinuousSplit
    calculator, parse = impurity.VarianceCalculator, jvm.org.apache.spark.mllib.linalg.Vectors.parse

    def made(at: int):
        n, *sums = tree.total[at].tolist()
        variance = max(0.0, (sums[2] - sums[1] ** 2 / sums[0]) / sums[0])
        stats = calculator(parse(f"[{','.join(map(repr, sums))}]").toArray(), int(n))
        if tree.feature[at] < 0:
            return leaf(float(tree.value[at]), variance, stats)
        feature = int(tree.feature[at])
        return inner(float(tree.value[at]), variance, float(tree.gain[at]), made(2 * at), made(2 * at + 1),
                     bound(feature, float(cuts[feature][tree.cut[at]])), stats)

    return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(f"dtr_{uuid.uuid4().hex[:12]}", made(1), len(cuts))
