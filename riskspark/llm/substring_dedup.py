"""Repeated byte strings across and inside documents, removed at every place they occur."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.common import bucketed, id_and_text, id_kind, materialize
from riskspark.llm.minhash import mix
from riskspark.llm.suffix_groups import neighbour_prefixes, suffix_array

LENGTH = 200
GRAM = 32                  # bytes of the hash that picks a window's anchor
HOT_CONTEXTS = 6_000       # distinct contexts of one anchor that a task orders; more are split by window
BATCH_BYTES = 150_000      # text of several anchors ordered together
PIECE = 1 << 20            # window starts hashed at once

_BYTE = np.random.default_rng(10).integers(1, 2**63, 256, dtype=np.uint64)
# one odd factor per doubling of the hashed width
_FACTORS = {1 << k: np.uint64(0x9E3779B97F4A7C15 + 0xBF58476D1CE4E5B8 * k & 0xFFFFFFFFFFFFFFFF | 1) for k in range(5)}
_PLACE = np.uint64(2**28 - 1)


def anchors(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(hash, position, first start, last start) of every anchor of a text.

    The anchor of the window at a start is the place, within it, of the lowest ``GRAM``-byte
    hash, leftmost of equals. So equal windows have equal anchors at the same distance, and
    neighbouring windows mostly share theirs.
    """
    found: list[list[np.ndarray]] = [[], [], [], []]
    for base in range(0, len(raw) - length + 1, PIECE):
        part = np.frombuffer(raw[base : base + PIECE + length - 1], np.uint8)
        h, width = _BYTE[part], 1
        while width < GRAM:
            h = h[:-width] * _FACTORS[width] + h[width:]
            width *= 2
        h = mix(h)
        low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        span, width = length - GRAM + 1, 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if span > width:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        at = (low & _PLACE).astype(np.int64)
        cut = np.flatnonzero(np.diff(at)) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut - 1, [len(at) - 1]])
        for column, values in zip(found, (h[at[first]], at[first] + base, first + base, last + base), strict=True):
            column.append(values)
    return tuple(np.concatenate(c) if c else np.empty(0, np.int64) for c in found)


ANCHOR_SCHEMA = "row long, h long, cd long, start long, n int, rel short"


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """One row per anchor: its hash, a digest of its context (all bytes of its windows and the
    anchor's distance), the first start, the number of starts and the distance."""
    for batch in batches:
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            raw = text.encode()
            if len(raw) < length:
                continue
            h, at, first, last = anchors(raw, length)
            rel = at - first
            digest = xxhash.xxh3_64_intdigest
            ends = (last + length).tolist()
            cd = np.fromiter(
                (digest(raw[a:b], seed=r) for a, b, r in zip(first.tolist(), ends, rel.tolist(), strict=True)), np.uint64, len(h))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(h), row)), pa.array(h.view(np.int64)), pa.array(cd.view(np.int64)), pa.array(first),
                 pa.array((last - first + 1).astype(np.int32)), pa.array(rel.astype(np.int16))],
                names=["row", "h", "cd", "start", "n", "rel"])


def _slices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts of each text."""
    for batch in batches:
        for wanted, text in zip(batch.column("wanted").to_pylist(), batch.column("text").to_pylist(), strict=True):
            raw = text.encode()
            yield pa.RecordBatch.from_arrays(
                [pa.array([w["h"] for w in wanted], pa.int64()), pa.array([w["cd"] for w in wanted], pa.int64()),
                 pa.array([w["rel"] for w in wanted], pa.int16()), pa.array([w["times"] for w in wanted], pa.int64()),
                 pa.array([raw[w["start"] : w["start"] + w["n"] + length - 1] for w in wanted], pa.binary())],
                names=["h", "cd", "rel", "times", "data"])


def shared_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle
    return low


def _agreement(parts: list[bytes]) -> list[int]:
    """For each string the longest prefix it shares with another one."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    best = [0] * len(parts)
    for a, b in zip(order, order[1:]):
        k = shared_prefix(parts[a], parts[b])
        best[a], best[b] = max(best[a], k), max(best[b], k)
    return best


def shared_parts(contexts: list[tuple[bytes, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """The range of each context (bytes, distance of the anchor) that can hold a window of another
    context of the same anchor: as far from the anchor as any other agrees, or empty."""
    right = _agreement([data[rel:] for data, rel in contexts])
    left = _agreement([data[:rel][::-1] for data, rel in contexts])
    return [(rel - x, rel + y) if x + y >= length else (rel, rel) for (_, rel), x, y in zip(contexts, left, right, strict=True)]


def covered_ranges(strings: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each string the ranges covered by ``length``-byte strings that another place also holds.

    The strings are joined with separators that occur once each, their suffixes ordered by
    ``suffix_array``, and every place kept whose longest shared prefix is long enough.
    """
    text: list[int] = []
    starts = []
    for k, s in enumerate(strings):
        starts.append(len(text))
        text += s
        text.append(256 + k)
    best = np.array(neighbour_prefixes(text, suffix_array(text)), np.int64)
    out = []
    for s, at in zip(strings, starts, strict=True):
        ranges: list[tuple[int, int]] = []
        for i in np.flatnonzero(best[at : at + len(s)] >= length).tolist():
            end = i + int(best[at + i])
            if ranges and i <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(end, ranges[-1][1]))
            else:
                ranges.append((i, end))
        out.append(ranges)
    return out


RANGE_SCHEMA = "h long, cd long, ranges array<struct<a:int,b:int>>"


def _ordered(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Covered ranges of the contexts of each anchor; rows of one anchor follow one another."""
    held: list[tuple[int, int, int, bytes]] = []   # h, cd, offset in the context, string
    whole: list[tuple[int, int, int, int]] = []    # h, cd and a range covered as it stands
    weight = 0
    group: list[tuple] = []

    def close() -> None:
        """Reduce the open group to the distinct strings its contexts share."""
        nonlocal weight
        contexts = [(data, rel) for _, _, rel, _, data in group]
        found: list[tuple[int, int, int, bytes]] = []
        for (h, cd, _, times, data), (a, b) in zip(group, shared_parts(contexts, length), strict=True):
            if times > 1:
                whole.append((h, cd, 0, len(data)))
            if b > a:
                found.append((h, cd, a if times == 1 else -1, data[a:b]))
        strings = {f[3] for f in found}
        if len(strings) > 1:
            held.extend(found)
            weight += sum(map(len, strings))
        elif len(found) > 1:  # all share one string, and no other anchor can hold its windows
            whole.extend((h, cd, a, a + len(part)) for h, cd, a, part in found if a >= 0)
        group.clear()

    def flush() -> pa.RecordBatch:
        nonlocal held, whole, weight
        # a string that several contexts share is repeated whole; the order needs it once
        times: dict[bytes, int] = {}
        for _, _, _, s in held:
            times[s] = times.get(s, 0) + 1
        distinct = list(times)
        found = dict(zip(distinct, covered_ranges(distinct, length), strict=True)) if distinct else {}
        keys_h, keys_cd, ranges = [], [], []
        for h, cd, offset, s in held:
            if offset < 0:
                continue
            own = [(0, len(s))] if times[s] > 1 else found[s]
            if own:
                keys_h.append(h)
                keys_cd.append(cd)
                ranges.append([{"a": a + offset, "b": b + offset} for a, b in own])
        for h, cd, a, b in whole:
            keys_h.append(h)
            keys_cd.append(cd)
            ranges.append([{"a": a, "b": b}])
        held, whole, weight = [], [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(keys_h, pa.int64()), pa.array(keys_cd, pa.int64()),
             pa.array(ranges, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], names=["h", "cd", "ranges"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("h", "cd", "rel", "times", "data")]
        for item in zip(*columns, strict=True):
            if group and group[-1][0] != item[0]:
                close()
                if weight >= BATCH_BYTES:
                    yield flush()
            group.append(item)
    if group:
        close()
    if held or whole:
        yield flush()


def _window_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every window of the contexts of very frequent anchors, by a 128-bit digest."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("h", "cd", "times", "data")]
        for h, cd, times, data in zip(*columns, strict=True):
            n = len(data) - length + 1
            digests = [xxhash.xxh3_128_digest(data[i : i + length]) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h] * n, pa.int64()), pa.array([cd] * n, pa.int64()), pa.array(range(n), pa.int32()),
                 pa.array([times] * n, pa.int64()), pa.array(digests, pa.binary())], names=["h", "cd", "i", "times", "w"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for cuts, text in zip(batch.column("cuts").to_pylist(), batch.column("text").to_pylist(), strict=True):
            raw, kept, done, spans, removed = text.encode(), [], 0, 0, 0
            merged: list[list[int]] = []
            for c in sorted(cuts or (), key=lambda c: (c["a"], c["b"])):
                if merged and c["a"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], c["b"])
                else:
                    merged.append([c["a"], c["b"]])
            for a, b in merged:
                kept.append(raw[done:a])
                removed += b - a
                spans += 1
                done = b
            kept.append(raw[done:])
            left = b"".join(kept)
            values = (len(raw), removed, spans, hashlib.sha256(left).hexdigest(), left)
            for column, v in zip(out, values, strict=True):
                column.append(v)
        types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(out, types, strict=True)]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_ranges(source: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, a, b): byte ranges of the texts in ``source`` (row, text; rows unique) that repeated
    strings cover. Ranges may overlap."""
    rows = materialize(
        source.mapInArrow(lambda it: _anchor_rows(it, length), ANCHOR_SCHEMA), "substring-anchors")
    groups = materialize(
        rows.groupBy("h").agg(F.count("*").alias("times"), F.min("cd").alias("lo"), F.max("cd").alias("hi"))
        .where("times > 1").select("h", (F.col("lo") == F.col("hi")).alias("same")), "substring-groups")
    repeated = materialize(rows.join(groups, "h"), "substring-repeated")
    # all contexts of the anchor are equal, so all its windows are repeated
    same = repeated.where("same").select("row", F.col("start").alias("a"), (F.col("start") + F.col("n") + length - 1).alias("b"))
    mixed = repeated.where("NOT same").select("row", "h", "cd", "start", "n", "rel")
    contexts = materialize(
        mixed.groupBy("h", "cd").agg(F.min(F.struct("row", "start", "n", "rel")).alias("at"), F.count("*").alias("times")),
        "substring-contexts")
    # one list per text, at most its anchors
    wanted = materialize(
        contexts.select("at.row", F.struct("h", "cd", "at.start", "at.n", "at.rel", "times").alias("w"))
        .groupBy("row").agg(F.collect_list("w").alias("wanted")), "substring-wanted")
    data = materialize(
        source.join(wanted.hint("merge"), "row").select("wanted", "text")
        .mapInArrow(lambda it: _slices(it, length), "h long, cd long, rel short, times long, data binary"), "substring-data")
    hot = materialize(contexts.groupBy("h").count().where(F.col("count") > HOT_CONTEXTS).select("h"), "substring-hot")
    ranges = (
        data.join(hot, "h", "left_anti").repartition("h").sortWithinPartitions("h", "cd")
        .select("h", "cd", "rel", "times", "data").mapInArrow(lambda it: _ordered(it, length), RANGE_SCHEMA))
    windows = materialize(
        data.join(hot, "h").select("h", "cd", "times", "data")
        .mapInArrow(lambda it: _window_rows(it, length), "h long, cd long, i int, times long, w binary"), "substring-windows")
    shared = materialize(windows.groupBy("w").agg(F.sum("times").alias("all")).where("all > 1").select("w"), "substring-shared")
    by_window = windows.join(shared, "w").select("h", "cd", F.array(F.struct(F.col("i").alias("a"), (F.col("i") + length).alias("b"))).alias("ranges"))
    ranges = materialize(ranges.unionByName(by_window), "substring-ranges")
    partly = mixed.join(ranges, ["h", "cd"]).select("row", "start", F.inline("ranges")).select(
        "row", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))
    return same.unionByName(partly)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes kept.

    Every byte covered by a ``length``-byte string (UTF-8 bytes, inside one document) that also
    starts anywhere else, in the same document or another, goes; strings are judged on the input.

    Windows meet through anchors (``anchors``). Anchors that occur once hold no repeat; where all
    contexts of an anchor are equal all is repeated. The other contexts are cut to the part they
    may share, and the suffix order of what is left tells which places repeat. Contexts of an
    anchor with more than ``HOT_CONTEXTS`` distinct ones are compared window by window over all
    tasks, so no task holds an unbounded group. Contexts are told apart by 64 bits of the anchor and 64 of
    the context, windows of such anchors by 128.

    Null and empty texts have no bytes; repeated rows are documents of their own, whose windows
    repeat each other's; null ids stay null; an empty table gives no rows; extra columns are
    ignored.
    """
    source = bucketed(
        id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "row", "substring_dedup")
    cuts = repeated_ranges(source.select("row", "text"), length).groupBy("row").agg(
        F.collect_list(F.struct("a", "b")).alias("cuts"))
    cuts = materialize(cuts, "substring-cuts")
    return source.join(cuts.hint("merge"), "row", "left").select("doc_id", "cuts", "text").mapInArrow(
        _cut, f"doc_id {id_kind(docs, id_col)}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
