"""Connected components of a distributed edge list."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.common import materialize

#: Edges, at most, that are one task's work; more of them go through rounds over all tasks.
TASK_EDGES = 250_000


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _lowest(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Each node's lowest neighbour. Written, so that the join that follows has a plain shuffle
    on both sides and a node with very many neighbours can be split over tasks."""
    return materialize(edges.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("low")), "component-lows")


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of the components of all edges of a task."""
    above: dict[int, int] = {}

    def root(n: int) -> int:
        while (up := above.get(n, n)) != n:
            above[n] = n = above.get(up, up)
        return n

    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                above[max(x, y)] = min(x, y)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array(list(map(root, nodes)), pa.int64())], names=["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not the lowest of its component.

    ``edges`` has long columns a and b. Union-find by alternating steps: every node hands its
    higher neighbours to its lowest one, then its lower neighbours; both keep the components
    and shorten all paths, until stars remain, after a number of rounds that grows with the
    logarithm of the longest path. Minima combine before the shuffle; nothing is gathered.
    Loops and repeated edges do no harm; no edges give no rows. Up to ``TASK_EDGES`` edges, a few
    megabytes, are less work than a round and are settled by one task.
    """
    if edges.count() <= TASK_EDGES:
        few = edges.select("a", "b").repartition(1).mapInArrow(_roots, "node long, root long")
        return materialize(few, "component-roots")
    e = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "component-edges")
    before = _signature(e)
    while before[0]:
        both = e.select(F.col("lo").alias("node"), F.col("hi").alias("next")).unionByName(
            e.select(F.col("hi").alias("node"), F.col("lo").alias("next")))
        lows = _lowest(both, "node", "next")
        e = materialize(
            both.join(lows, "node").where("next > node")
            .select(F.col("next").alias("hi"), F.least("low", "node").alias("lo")).distinct(), "component-large")
        lows = _lowest(e, "hi", "lo").withColumnRenamed("node", "hi")
        e = materialize(
            e.join(lows, "hi").select(F.inline(F.array(
                F.struct(F.col("hi"), F.col("low").alias("lo")),
                F.struct(F.col("lo").alias("hi"), F.col("low").alias("lo")))))
            .where("hi <> lo").distinct(), "component-small")
        after = _signature(e)
        if after == before:
            break
        before = after
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
