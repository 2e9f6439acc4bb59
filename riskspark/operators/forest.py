"""Probabilities of a boosted model by batches of rows, one tree after the other.

MLlib takes a row through all trees before the next one, and the nodes of some hundred trees do not fit a core's cache. Here
a batch goes through a tree at once: a split compares a column with a bound for all rows, each such comparison is made
once for all trees, and the leaf of every row is chosen from below by bit operations. Trees are read from MLlib's model.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, functions as F, types as T

#: Rows that go through all trees together, at most.
PIECE = 1 << 14

_TREE = re.compile(r"Tree \d+ \(weight (\S+)\):$")
_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)$")
_LEAF = re.compile(r"Predict: (\S+)$")


@dataclass
class Member:
    """A tree from the root on: per split its column and bound and where its sides lie, leaves as ``-1 - number``."""

    weight: float
    splits: list[tuple[int, float]]
    sides: list[list[int]]
    leaves: list[float]


def members(model: GBTClassificationModel) -> list[Member] | None:
    """The trees of the model, or None where a split is none by a bound."""
    found: list[Member] = []
    for line in map(str.strip, model.toDebugString.splitlines()):
        if tree := _TREE.match(line):
            found.append(Member(float(tree[1]), [], [], []))
            path: list[int] = []  # splits whose right side is still to come
            continue
        if not found or line.startswith("Else"):
            continue
        at, tree = found[-1], None
        if split := _SPLIT.match(line):
            place = len(at.splits)
            at.splits.append((int(split[1]), float(split[2])))
            at.sides.append([])
        elif leaf := _LEAF.match(line):
            place = -1 - len(at.leaves)
            at.leaves.append(float(leaf[1]))
        elif line:
            return None
        else:
            continue
        while path and len(at.sides[path[-1]]) == 2:
            path.pop()
        if path:
            at.sides[path[-1]].append(place)
        if place >= 0:
            path.append(place)
    return found


class Forest:
    """Trees ready for batches: splits from the last to the first, so that what lies below one is there before it."""

    def __init__(self, trees: Sequence[Member]):
        self.bounds = sorted({split for tree in trees for split in tree.splits})
        number = {split: i for i, split in enumerate(self.bounds)}
        self.trees = []
        for tree in trees:
            kind = np.uint8 if len(tree.leaves) <= 256 else np.uint32
            steps = [(number[tree.splits[i]], *(np.array(-1 - side, kind) if side < 0 else None for side in tree.sides[i]))
                     for i in reversed(range(len(tree.splits)))]
            self.trees.append((kind, steps, tree.weight * np.array(tree.leaves)))

    def margins(self, x: np.ndarray) -> np.ndarray:
        """The weighted sum over all trees per row of ``x``, a row per column of the model."""
        parts = [self._margins(x[:, low : low + PIECE]) for low in range(0, x.shape[1], PIECE)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _margins(self, x: np.ndarray) -> np.ndarray:
        rows, total = x.shape[1], np.zeros(x.shape[1])
        with np.errstate(invalid="ignore"):
            above = [~(x[column] <= bound) for column, bound in self.bounds]  # NaN goes right, as in MLlib
        masks = {kind: [np.negative(a.astype(kind)) for a in above] for kind in {k for k, _, _ in self.trees}}  # all bits or none
        spare: dict[type, list[np.ndarray]] = {kind: [] for kind in masks}
        both, xor = np.bitwise_and, np.bitwise_xor
        for kind, steps, leaves in self.trees:
            if not steps:
                total += leaves[0]
                continue
            free, chosen = spare[kind], []  # the leaves chosen below the splits seen last, the left side on top
            for bound, left, right in steps:
                mask = masks[kind][bound]
                a = chosen.pop() if left is None else left
                b = chosen.pop() if right is None else right
                to = b if right is None else free.pop() if free else np.empty(rows, kind)
                xor(a, b, out=to)
                both(to, mask, out=to)
                xor(to, a, out=to)
                if left is None:
                    free.append(a)
                chosen.append(to)
            total += leaves.take(chosen[0])
            free.append(chosen[0])
        return total


def probability(trees: Sequence[Member], vector: Column) -> Column:
    """MLlib's probability of class 1 of an array column."""
    forest = Forest(trees)

    def of(x: pa.Array) -> pa.Array:
        rows = len(x)
        values = x.flatten().to_numpy(zero_copy_only=False)
        if x.null_count or rows and len(values) % rows:
            raise ValueError("every row needs a vector of one length")
        columns = np.ascontiguousarray(values.reshape(rows, -1).T) if rows else np.zeros((1, 0))
        with np.errstate(over="ignore"):
            return pa.array(1 - 1 / (1 + np.exp(2 * forest.margins(columns))), pa.float64())

    return F.arrow_udf(of, T.DoubleType())(vector)
