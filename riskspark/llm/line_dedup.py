"""Fuzzy line deduplication: one line of each group of near-equal lines stays in the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.common import bucketed, drop_shuffles, materialize
from riskspark.llm.links import distinct_keys, link
from riskspark.llm.minhash import mix

SHINGLE = 5            # code points, so that scripts of two and three bytes are judged alike
BANDS, ROWS = 36, 6    # lines at similarity 0.8 share no band with probability 1.8e-5, at 0.9 3e-12
PERCENT = 80
CHUNK = 64_000         # bytes sketched at once, so that the arrays stay in the processor's cache
RANGE_KEYS = 2_000_000  # band keys that one range of the key space holds, about

_seed = np.random.default_rng(9)
_BYTE = _seed.integers(1, 2**63, 256, dtype=np.uint64)
_FACTORS = (_seed.integers(1, 2**62, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).tolist()
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ROUNDS = 2 * BANDS * ROWS
_FLIP = _seed.integers(0, 2**32, _ROUNDS, dtype=np.uint32)
_TIMES = _seed.integers(0, 2**31, _ROUNDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_EMPTY = np.uint32(2**32 - 1)


def normal_line(line: str) -> bytes:
    """A-Z lower-cased, runs of ASCII white space as one space, none at the ends."""
    return b" ".join(line.encode().lower().split())


def text_lines(text: str) -> list[tuple[int, bytes]]:
    """(position, normalised line) of the lines that hold a word."""
    return [(i, b" ".join(words)) for i, line in enumerate(text.encode().lower().split(b"\n")) if (words := line.split())]


def lines_at(batch: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    """Names and normalised lines of the ``wanted`` (lo, pos) of each ``text`` of a batch."""
    wanted = batch.column("wanted")
    each = wanted.flatten()
    names, places = (each.field(c).to_numpy() for c in ("lo", "pos"))
    ends, places = np.cumsum(wanted.value_lengths().to_numpy()).tolist(), places.tolist()
    out, at = [], 0
    for end, text in zip(ends, batch.column("text").to_pylist(), strict=True):
        lines = text.encode().lower().split(b"\n")
        out += [b" ".join(lines[i].split()) for i in places[at:end]]
        at = end
    return names, out


def points(line: bytes) -> int:
    """Code points of a normalised line."""
    return len(line) if line.isascii() else len(line.decode())


def rolling_hashes(raw: bytes, wide: bool = True) -> np.ndarray:
    """Hashes of all strings of ``SHINGLE`` code points of ``raw``, in order: of 64 bits, or of 32."""
    if raw.isascii():
        one = _BYTE[np.frombuffer(raw, np.uint8)]
    else:
        code = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        one = np.where(code < 256, _BYTE[np.minimum(code, 255)], mix(code * _STEP))
    h = one if wide else (one >> np.uint64(32)).astype(np.uint32)
    one, kind = h, h.dtype.type
    for k, width in enumerate((1, 2)):  # hashes of 2, then 4 code points
        h = h[:-width] * kind(_FACTORS[k] % 2**32 if not wide else _FACTORS[k]) + h[width:]
    h = h[:-1] * kind(_FACTORS[2] % 2**32 if not wide else _FACTORS[2]) + one[4:]
    if wide:
        return mix(h)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def line_sketches(items: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """MinHash-like signatures of ``n`` sets at once, one row per set: ``items`` are 32-bit hashes,
    ``owner`` names the set of each.

    Every round hashes all items anew into a coordinate of their set, which keeps the lowest (round,
    hash); sets whose coordinates are all filled leave. The last rounds send all items to one
    coordinate each, so none stays empty. Two sets agree in a coordinate with probability equal to
    their similarity, as with one hash function per coordinate, for far fewer hashes of long lines.
    """
    size = BANDS * ROWS
    bins = np.full(n * size, _EMPTY, np.uint32)
    at = owner * size
    for turn in range(_ROUNDS):
        h = (items ^ _FLIP[turn]) * _TIMES[turn]
        h ^= h >> np.uint32(15)
        place = at + ((h >> np.uint32(16)) * np.uint32(size) >> np.uint32(16)) if turn < size else at + (turn - size)
        h *= np.uint32(0x2C1B3C6D)
        np.minimum.at(bins, place, (h >> np.uint32(9)) | np.uint32(turn << 23))
        unfilled = bins.reshape(n, size).max(axis=1) == _EMPTY
        left = np.count_nonzero(unfilled)
        if left == 0:
            break
        if left < 0.8 * n:
            rest = unfilled[at // size]
            items, at = items[rest], at[rest]
    return bins.reshape(n, size)


def line_bands(lines: list[bytes], sizes: np.ndarray | None = None) -> np.ndarray:
    """Band keys, one row per line; every line has at least ``SHINGLE`` code points, ``sizes`` if given."""
    h = rolling_hashes(b"".join(lines), wide=False)
    if sizes is None:
        sizes = np.fromiter(map(points, lines), np.int64, len(lines))
    inside = np.ones(sizes.sum(), bool)
    for k in range(1, SHINGLE):  # no string runs over the end of its line
        inside[np.cumsum(sizes) - k] = False
    owner = np.repeat(np.arange(len(lines)), sizes - SHINGLE + 1)
    rows = line_sketches(h[inside[: len(h)]], owner, len(lines)).reshape(len(lines), BANDS, ROWS)
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(lines), axis=0)
    for i in range(ROWS):
        keys = mix(keys * _STEP + rows[:, :, i])
    return keys


def chunks(lines: list[bytes]) -> Iterator[list[int]]:
    """Places of the lines in parts of about ``CHUNK`` bytes and of lines of about one length."""
    part: list[int] = []
    held = 0
    for i in sorted(range(len(lines)), key=lambda i: len(lines[i])):
        part.append(i)
        held += len(lines[i])
        if held >= CHUNK:
            yield part
            part, held = [], 0
    if part:
        yield part


def all_bands(lines: list[bytes], sizes: np.ndarray | None = None) -> np.ndarray:
    """``line_bands`` in chunks of lines of about one length, which need about as many rounds."""
    out = np.empty((len(lines), BANDS), np.uint64)
    for part in chunks(lines):
        out[part] = line_bands([lines[j] for j in part], None if sizes is None else sizes[part])
    return out


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """``np.unique`` without its overhead for short arrays."""
    h = np.sort(hashes)
    keep = np.empty(len(h), bool)
    keep[:1] = True
    np.not_equal(h[1:], h[:-1], out=keep[1:])
    return h[keep]


def set_sizes(lines: list[bytes]) -> np.ndarray:
    """How many distinct shingles each line has, many lines at once."""
    sizes = np.fromiter(map(points, lines), np.int64, len(lines))
    out = np.zeros(len(lines), np.int64)
    for part in chunks(lines):
        part = [i for i in part if sizes[i] >= SHINGLE]
        if not part:
            continue
        h = rolling_hashes(b"".join([lines[i] for i in part]))
        at = 0
        for i, n in zip(part, sizes[part].tolist(), strict=True):
            out[i] = len(_distinct(h[at : at + n - SHINGLE + 1]))
            at += n
    return out


def shingle_hashes(line: bytes) -> np.ndarray:
    """The set of a line's shingles, by their 64-bit hashes; empty for shorter lines."""
    return _distinct(rolling_hashes(line)) if points(line) >= SHINGLE else np.empty(0, np.uint64)


LINE_SCHEMA = "row long, pos int, lo long, hi long"


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, pos and digest of every line with a word."""
    for batch in batches:
        rows, places, digests = [], [], []
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for i, line in text_lines(text):
                rows.append(row)
                places.append(i)
                digests.append(xxhash.xxh3_128_digest(line))
        both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(places, pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1])],
            names=["row", "pos", "lo", "hi"])


RUN_SCHEMA = "place int, keys binary, node_high binary, node_low binary"
_KEY_BITS, _NODE_BITS = 44, 40


def _runs(place: np.ndarray, keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
    """One row per place: its sorted keys as differences (4 bytes each where all fit) and nodes of 5 bytes."""
    starts = np.flatnonzero(np.diff(place, prepend=-1)) if len(place) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(place)).astype(np.int64)
    packed, high, low = [], [], []
    for a, b in zip(starts, ends, strict=True):
        gaps = np.diff(keys[a:b], prepend=np.uint64(0))
        small = len(gaps) < 2 or int(gaps[1:].max()) < 2**32
        packed.append(keys[a : a + 1].tobytes() + gaps[1:].astype("<u4").tobytes() if small else b"\0" * 8 + keys[a:b].tobytes())
        high.append((nodes[a:b] >> np.uint64(8)).astype("<u4").tobytes())
        low.append(nodes[a:b].astype("u1").tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(place[starts], pa.int32()), *(pa.array(x, pa.binary()) for x in (packed, high, low))],
        names=["place", "keys", "node_high", "node_low"])


def _unpacked(keys: bytes, high: bytes, low: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(low)
    if len(keys) == 8 + 8 * n:  # written whole, after a mark of eight bytes
        key = np.frombuffer(keys, "<u8", n, 8)
    else:
        key = np.cumsum(np.concatenate([np.frombuffer(keys, "<u8", 1), np.frombuffer(keys, "<u4", n - 1, 8).astype("<u8")]))
    return key, (np.frombuffer(high, "<u4").astype(np.uint64) << np.uint64(8)) | np.frombuffer(low, "u1")


def _band_runs(ranges: int):
    """Band keys of the wanted lines of each batch, as sorted runs per range of the key space.

    A key that several lines of the batch hold is known to be shared: all of them go to a place
    beyond the ranges, which only hands them on, and one goes to the key's range for the batch.
    So a range sees a key once per batch, however many lines hold it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, lines = lines_at(batch)
            sizes = np.fromiter(map(points, lines), np.int64, len(lines))
            long = sizes >= SHINGLE
            if not long.any():
                continue
            keys = (all_bands([line for line, ok in zip(lines, long.tolist(), strict=True) if ok], sizes[long])
                    >> np.uint64(64 - _KEY_BITS)).ravel()
            node = np.repeat(nodes[long].view(np.uint64) >> np.uint64(64 - _NODE_BITS), BANDS)
            order = np.argsort(keys)
            keys, node = keys[order], node[order]
            first = np.diff(keys, prepend=~keys[:1]) != 0
            place = (keys * np.uint64(ranges) >> np.uint64(_KEY_BITS)).astype(np.int32)
            yield _runs(place[first], keys[first], node[first])
            again = ~first | np.append(~first[1:], False)
            if again.any():
                yield _runs(place[again] + ranges, keys[again], node[again])

    return run


def _shared_keys(ranges: int):
    """(key, node) of the keys of a range that several lines hold."""

    def run(place: tuple[pa.Scalar, ...], runs: pa.Table) -> pa.Table:
        found = [_unpacked(*r) for r in zip(*(runs.column(c).to_pylist() for c in ("keys", "node_high", "node_low")), strict=True)]
        keys, nodes = (np.concatenate(x) for x in zip(*found, strict=True))
        if place[0].as_py() < ranges:
            order = np.argsort(keys, kind="stable")
            keys, nodes = keys[order], nodes[order]
            same = keys[1:] == keys[:-1]
            shared = np.append(same, False) | np.append(False, same)
            keys, nodes = keys[shared], nodes[shared]
        return pa.table({"key": keys.view(np.int64), "part": nodes.view(np.int64)})

    return run


def shared_bands(texts: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (key, node, n, times) of the band keys that several distinct lines hold, as ``distinct_keys`` gives
    them, and of each distinct line (lo) one place (row, pos) and how often it occurs.

    Every distinct line is sketched once. Most of its keys are its own, so they travel packed, 9
    bytes each, to ranges of the key space that find those held more than once; a range has about
    ``RANGE_KEYS`` of them whatever the corpus. Keys of 44 bits and the 40 bits by which a range
    names a line may coincide for others; such members only cost a comparison.
    """
    spark = texts.sparkSession
    # row and pos are of one line, as both are taken of the same rows; any line will do
    places = materialize(lines.groupBy("lo").agg(F.first("row").alias("row"), F.first("pos").alias("pos"), F.count("*").alias("n")),
                         "line-places")
    # one list per document, at most its lines
    wanted = places.groupBy("row").agg(F.collect_list(F.struct("lo", "pos")).alias("wanted"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(4 * parts, places.count() * BANDS // RANGE_KEYS + 1)
    runs = texts.join(wanted.hint("merge"), "row").select("wanted", "text").mapInArrow(_band_runs(ranges), RUN_SCHEMA)
    shared = materialize(runs.groupBy("place").applyInArrow(_shared_keys(ranges), "key long, part long").distinct(), "line-keys")
    drop_shuffles(spark)  # the packed keys
    names = places.select(F.shiftrightunsigned("lo", 64 - _NODE_BITS).alias("part"), F.col("lo").alias("node"))
    members = distinct_keys(shared.withColumnRenamed("part", "node")).withColumnRenamed("node", "part")
    return materialize(members.join(names, "part").drop("part"), "line-buckets"), places


def _wanted_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, lines = lines_at(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes), pa.array(lines, pa.binary()), pa.array(set_sizes(lines))], names=["node", "data", "size"])


def _without(rows: DataFrame) -> DataFrame:
    """``rows`` with n_lines, the lines of ``text`` that hold a word, n_removed, and ``text`` without the lines at the places
    ``drop`` (null: none)."""
    # a column of their own, as the places are looked up one by one
    rows = rows.withColumn("lines", F.split("text", "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    whole = F.col("drop").isNull()
    return rows.select(
        *[c for c in rows.columns if c not in ("text", "drop", "lines")],
        F.size(F.filter("lines", lambda line: line.rlike("[^ \t\n\x0B\f\r]"))).cast("long").alias("n_lines"),
        F.when(whole, 0).otherwise(F.size("drop")).cast("long").alias("n_removed"),
        F.when(whole, F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n")).alias("text"))


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, a unique row number and all other columns under one struct, bucketed by row."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None).cast("string")
    return bucketed(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), F.col(f"`{text_col}`").isNull().alias("no_text"),
        rest.alias("rest")), "row", "line_dedup")


def dedup_lines(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document: doc_id, rest (its other columns), n_lines, n_removed and the text left.

    Lines between ``\\n`` that hold a word are compared after ``normal_line``. Equal lines, and
    lines whose sets of shingles of ``SHINGLE`` code points reach ``percent`` Jaccard similarity, are
    linked; of each component of links the line of the lowest doc_id (null last), then of the
    first row, then the first in the text stays, all others go with one line end. Lines of fewer
    than ``SHINGLE`` code points are linked only if equal. Blank lines stay.

    Equal lines are found by 128-bit digests, so a line that a third of the documents holds is
    one node; near links use 64 bits of it. Null text stays null and has no lines; repeated rows
    are documents of their own, of which the first keeps the lines; an empty table gives no rows;
    extra columns, whatever their names, are carried in ``rest``.
    """
    source = numbered(docs, id_col, text_col)
    texts = source.select("row", "text")
    lines = materialize(texts.mapInArrow(_line_rows, LINE_SCHEMA), "line-ids")

    members, places = shared_bands(texts, lines)
    nodes = members.select(F.col("node").alias("lo")).distinct()
    # one list per document, at most its lines
    wanted = materialize(places.join(nodes, "lo", "left_semi").groupBy("row").agg(
        F.collect_list(F.struct("lo", "pos")).alias("wanted")), "line-wanted")
    sets = materialize(texts.join(wanted.hint("merge"), "row").select("wanted", "text")
                       .mapInArrow(_wanted_lines, "node long, data binary, size long"), "line-texts")
    labels, _ = link(members, sets, shingle_hashes, percent)
    drop_shuffles(docs.sparkSession)

    # the root of a labelled component carries no label of its own
    marks = labels.select(F.col("node").alias("lo"), "root").unionByName(
        labels.select(F.col("root").alias("lo"), "root").distinct())
    # lines that occur once and are near to no other stay
    repeated = places.select("lo", "n").join(marks, "lo", "left").where("n > 1 OR root IS NOT NULL").select("lo", "root")
    grouped = materialize(lines.join(repeated, "lo").select(
        "row", "pos", F.coalesce("root", "lo").alias("c1"), F.when(F.col("root").isNull(), F.col("hi")).alias("c2")), "line-groups")
    owners = source.select("row", "doc_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "pos")
    first = materialize(
        grouped.join(owners, "row").groupBy("c1", "c2").agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select(F.col("c1").alias("f1"), F.col("c2").alias("f2"), F.col("first.row").alias("keep_row"),
                               F.col("first.pos").alias("keep_pos")), "line-first")
    drops = (grouped.join(first, (F.col("c1") == F.col("f1")) & F.col("c2").eqNullSafe(F.col("f2")))
             .where("row <> keep_row OR pos <> keep_pos")
             .groupBy("row").agg(F.collect_list("pos").alias("drop")))
    drops = materialize(drops, "line-drops")
    cut = _without(source.join(drops.hint("merge"), "row", "left"))
    return cut.select("doc_id", "rest", "n_lines", "n_removed", F.when(~F.col("no_text"), F.col("text")).alias("text"))
