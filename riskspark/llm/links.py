"""From shared band keys to verified components, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.common import drop_shuffles, materialize
from riskspark.llm.components import components

#: Nodes of a key, at most, that make do with coarse bits.
FEW = 8
#: Cells of an element in the bits of nodes that meet more than ``FEW`` others, and 2^cells at most in a node's bits.
FINE, CELL_BITS = 4, 20
#: Nodes of a key, at most, that one task compares.
BLOCK = 2048

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def shared_buckets(members: DataFrame) -> DataFrame:
    """Rows (key, node) whose key at least two nodes share; written once."""
    keys = members.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("key")
    keys = materialize(keys, "bucket-keys")
    return materialize(members.join(keys, "key"), "buckets")


def distinct_keys(members: DataFrame) -> DataFrame:
    """(key, node, n, times): of the keys that hold the same nodes one, with the number of its nodes and of such keys.

    Near copies share many bands, so most keys repeat the nodes of another. Sets of nodes are told apart by 128 bits.
    """
    per_key = members.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    kept = per_key.where("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key"), F.count("*").alias("times"))
    return members.select("key", "node").join(materialize(kept.select("key", "n", "times"), "link-keys"), "key")


def compared(pairs: DataFrame, sets: DataFrame, elements: Callable[[bytes], np.ndarray]) -> DataFrame:
    """(a, b, common, size_a, size_b): the sizes of each pair's full sets and of their intersection; contents travel to
    the pairs by shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(maxsize=4096)(elements)  # members of a group come back again and again
        for b in batches:
            found = []
            for x, y in zip(b.column("data_a"), b.column("data_b"), strict=True):
                x, y = known(x.as_py()), known(y.as_py())
                found.append((len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            sizes = np.array(found, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b"), *(pa.array(sizes[:, i]) for i in range(3))], names=["a", "b", "common", "size_a", "size_b"])

    left = sets.select(F.col("node").alias("a"), F.col("data").alias("data_a"))
    right = sets.select(F.col("node").alias("b"), F.col("data").alias("data_b"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(
        run, "a long, b long, common long, size_a long, size_b long")


def element_bits(sets: DataFrame, nodes: DataFrame, elements: Callable[[bytes], np.ndarray], per_element: int) -> DataFrame:
    """(node, bits): the parity of the elements of each node's set in 2^k cells, at least ``per_element`` cells an element.

    An element that two sets share falls out of the difference of their bits, so that has at most as many ones as elements
    that only one of them holds. A wider set is folded onto fewer cells by its halves' difference.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = []
            for data in b.column("data"):
                items = elements(data.as_py())
                cells = 1 << min(max(len(items) * per_element - 1, 0).bit_length(), CELL_BITS)
                place = ((items * _SPREAD) >> np.uint64(32)).astype(np.int64) & (max(cells, 64) - 1)
                bits.append(np.packbits(np.bincount(place, minlength=max(cells, 64)).astype(np.uint8) & 1).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(bits, pa.binary())], names=["node", "bits"])

    return sets.join(nodes, "node", "left_semi").select("node", "data").mapInArrow(run, "node long, bits binary")


def novel_elements(sets: DataFrame, nodes: DataFrame, elements: Callable[[bytes], np.ndarray]) -> DataFrame:
    """(node, bits): ``element_bits`` of nodes that meet many others, fine enough to tell nearly all elements that one
    of two nodes has and the other lacks."""
    return element_bits(sets, nodes, elements, FINE)


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def _close(node: np.ndarray, comp: np.ndarray, size: np.ndarray, side: np.ndarray, bits: list[bytes], percent: int,
           forest: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays (a, b) of the nodes of two components, and of two sides where there are two, whose bits do not exclude a
    link; of a ``forest`` only so many as join all components that these pairs may join."""
    width = np.fromiter(map(len, bits), np.int64, len(bits)) // 8
    kinds, of, n = np.unique(comp, return_inverse=True, return_counts=True)
    if len(kinds) < 2:
        return
    outside = of != n.argmax()  # each pair across components has such a node
    above = list(range(len(kinds)))

    def root(k: int) -> int:
        while above[k] != k:
            above[k] = k = above[above[k]]
        return k

    def joining(x: np.ndarray, y: np.ndarray) -> list[int]:
        kept, now = [], np.fromiter(map(root, range(len(kinds))), np.int64, len(kinds))[of]
        for at in np.flatnonzero(now[x] != now[y]).tolist():
            p, q = root(int(of[x[at]])), root(int(of[y[at]]))
            if p != q:
                above[p] = q
                kept.append(at)
        return kept

    two = side.min() != side.max()
    for w in np.unique(width):
        here = np.flatnonzero(width >= w)
        own = width[here] == w  # wider sets meet each other at their own width
        words = np.empty((len(here), w), np.uint64)
        for k in np.unique(width[here]):
            which = np.flatnonzero(width[here] == k)
            raw = np.frombuffer(b"".join([bits[i] for i in here[which]]), np.uint64).reshape(len(which), k)
            words[which] = _folded(raw, w)
        step, pairs = max(1, (1 << 20) // len(here)), max(1, (1 << 20) // int(w))
        rows = np.flatnonzero(outside[here])
        for at in range(0, len(rows), step):
            r = rows[at : at + step]
            u, v = here[r][:, None], here[None, :]
            total = (size[u] + size[v]) * (100 - percent)
            ok = (comp[u] != comp[v]) & (own[r][:, None] | own[None, :]) & ((100 + percent) * np.abs(size[u] - size[v]) <= total)
            ok &= ~outside[v] | (node[u] < node[v])  # a pair of two such nodes once
            if two:
                ok &= side[u] != side[v]
            i, j = np.nonzero(ok)
            for cut in range(0, len(i), pairs):
                p, q = i[cut : cut + pairs], j[cut : cut + pairs]
                apart = np.bitwise_count(words[r[p]] ^ words[q]).sum(axis=1, dtype=np.int64)
                left = (100 + percent) * apart <= total[p, q]
                x, y = here[r[p[left]]], here[q[left]]
                if forest:
                    kept = joining(x, y)
                    x, y = x[kept], y[kept]
                if len(x):
                    yield node[x], node[y]


def close_pairs(rows: DataFrame, percent: int, forest: bool = False) -> DataFrame:
    """(a, b): the pairs of one key and two components that sizes and bits leave open; ``rows`` has (key, n, node, comp,
    size, bits), n the nodes of the key. Of a ``forest`` a key gives at most one pair less than it has components.

    Keys are compared in tasks, each by arrays; one of more than ``BLOCK`` nodes is cut into blocks, of which any two meet
    in a task of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("node", "comp", "size", "block")

        def found(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(parts).combine_chunks()
            columns = [t.column(c).to_numpy() for c in names]
            for x, y in _close(*columns, t.column("bits").to_pylist(), percent, forest):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            cell = np.stack([b.column(c).to_numpy() for c in ("key", "low", "high")])
            if not b.num_rows:
                continue
            starts = [0, *(np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
            for start, end in zip(starts[:-1], starts[1:], strict=True):
                here = tuple(cell[:, start].tolist())
                if held and here != last:
                    yield from found(held)
                    held = []
                held.append(b.slice(start, end - start))
                last = here
        if held:
            yield from found(held)

    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    cells = (rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                     "node", "comp", "size", "block", "bits"))
    return cells.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(run, "a long, b long").distinct()


def link(members: DataFrame, sets: DataFrame, elements: Callable[[bytes], np.ndarray], percent: int) -> tuple[DataFrame, DataFrame]:
    """(labels, edges): labels are ``components`` of the verified links between bucket members.

    ``members`` has (key, node), rows of keys that nodes share, or what ``distinct_keys`` makes of them;
    ``sets`` has (node, data, size), ``elements`` gives the distinct hashes that ``data`` stands for. A
    pair is a candidate if it shares a key and its sizes allow ``percent`` Jaccard similarity. Of keys
    with the same nodes one is looked at; a key of two nodes is one pair and waits for the end. First each
    node is compared with one pivot: of the pivots of its buckets the one that meets most other nodes,
    which is the middle of its group. So a large group of near copies costs one comparison per node.

    Then the remaining candidate pairs across two components are compared; inside one component
    a further link would change nothing. An exact bound keeps nodes that drifted a little too far
    from a large group from being compared with each of its members: each node's set is put into
    bits whose differences are at most those of the sets, and pairs whose bits differ by more
    than the similarity allows are no links. One row per node and key travels for it, not one per element.
    """
    if "times" not in members.columns:
        members = distinct_keys(members)
    members = materialize(members.join(sets.select("node", "size"), "node"), "link-members")
    edges = labels = None

    def settle(pairs: DataFrame) -> None:
        """Compare pairs, extend the edges, label the nodes anew."""
        nonlocal edges, labels
        found = materialize(compared(materialize(pairs, "link-pairs"), sets, elements), "link-compared")
        drop_shuffles(sets.sparkSession)
        new = found.where(100 * F.col("common") >= percent * (F.col("size_a") + F.col("size_b") - F.col("common"))).select("a", "b")
        edges = new if edges is None else edges.unionByName(new)
        # what is labelled goes in as stars
        labels = components(new if labels is None else new.unionByName(labels.toDF("a", "b")))

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(labels, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")

    def fits(small: Column, large: Column) -> Column:
        """Whether sets of two sizes can reach the similarity."""
        return 100 * small >= percent * large

    many = members.where("n > 2")
    weights = many.groupBy("node").agg(F.sum(F.col("n") * F.col("times")).alias("weight"))
    pivots = materialize(
        many.join(weights, "node").groupBy("key").agg(
            F.min(F.struct((-F.col("weight")).alias("less"), F.xxhash64("node").alias("place"), F.col("node").alias("pivot"),
                           F.col("size").alias("other_size"))).alias("p"))
        .select("key", "p.pivot", "p.other_size", (-F.col("p").getField("less")).alias("rank")), "link-pivots")
    chosen = (many.join(pivots, "key").where(F.col("node") != F.col("pivot"))
              .where(fits(F.least("size", "other_size"), F.greatest("size", "other_size")))
              .groupBy("node", "pivot", "rank").agg(F.sum("times").alias("times"))
              .groupBy("node").agg(F.max(F.struct("rank", "times", "pivot")).alias("best")).select("node", "best.pivot"))
    settle(chosen.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())

    mixed = labelled(many).groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    rest = materialize(many.join(mixed, "key").select("key", "n", "node", "size"), "link-rest")
    few, many = rest.where(F.col("n") <= FEW), rest.where(F.col("n") > FEW)
    coarse = materialize(element_bits(sets, few.select("node").distinct(), elements, 1), "link-coarse")
    fine = materialize(novel_elements(sets, many.select("node").distinct(), elements), "link-fine")
    # what of a key may hang together is tried by one pair per component first, so that groups which no pivot met do not
    # come with all their pairs
    settle(close_pairs(labelled(many).join(fine, "node"), percent, forest=True))

    close = close_pairs(labelled(few).join(coarse, "node").unionByName(labelled(many).join(fine, "node")), percent)
    twos = (labelled(members.where("n = 2")).groupBy("key").agg(
        F.min("node").alias("a"), F.max("node").alias("b"), F.min("size").alias("small"), F.max("size").alias("large"),
        F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").where(fits(F.col("small"), F.col("large"))).select("a", "b"))
    settle(close.unionByName(twos).distinct())
    return labels, edges
