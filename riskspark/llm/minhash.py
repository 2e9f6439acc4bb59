"""Near-duplicate documents: similarity sketches, banding, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.common import id_and_text, id_kind, materialize
from riskspark.llm.links import link, shared_buckets

BANDS, ROWS = 64, 8          # a pair at similarity 0.8 shares no band with probability 8e-6
PERCENT = 80
MEMO_WORDS = 400_000

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of hashed word shingles; words are hashed once per task while remembered."""

    def __init__(self, words: int):
        self.words = words
        self.memo: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        """Sorted distinct hashes of the shingles of the whole text, A-Z lower-cased."""
        words = text.encode().lower().split()
        n = len(words)
        if n == 0:
            return np.empty(0, np.uint64)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo = self.memo
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
        k = min(self.words, n)
        out = np.full(n - k + 1, k, np.uint64)
        for i in range(k):
            out = mix(out * _STEP + h[i : n - k + 1 + i])
        return np.unique(out)


def sketch(items: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketch of a set of 64-bit hashes.

    In round i every item is hashed anew; in the first ``size`` rounds the hash also picks its
    bin, in the next ``size`` rounds all items go to bin i - ``size``. A bin keeps the lowest
    (round, hash), and rounds end once no bin is empty, so each coordinate is filled by at most
    2 x ``size`` rounds, and two sketches agree in a coordinate with probability equal to the
    Jaccard similarity, concentrated about as for independent samples. Rounds are run in blocks
    of some thousand hashes.
    """
    bits = np.uint64(64 - (size.bit_length() - 1))
    bins = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    block = max(1, 4 * size // len(items))
    done = 0
    while done < 2 * size:
        rounds = np.arange(done, min(done + block, 2 * size), dtype=np.uint64)
        h = mix(items[None, :] + (rounds[:, None] + np.uint64(1)) * _STEP)
        place = (h >> bits).astype(np.int64)
        late = rounds >= size
        place[late] = (rounds[late] - np.uint64(size)).astype(np.int64)[:, None]
        value = (rounds[:, None] << np.uint64(52)) | (mix(h) >> np.uint64(12))
        np.minimum.at(bins, place.ravel(), value.ravel())
        done += len(rounds)
        # bins filled in rounds after the first complete one never beat an earlier value
        if bins.max() != np.iinfo(np.uint64).max:
            break
    return bins


def band_keys(items: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    rows_of = sketch(items, bands * rows).reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        key = mix(key * _STEP + rows_of[:, i])
    return key


SKETCH_SCHEMA = "doc_id {id}, row long, n_shingles long, digest binary, bands array<long>"


def sketches(source: DataFrame, shingle: int) -> DataFrame:
    """doc_id, row, n_shingles, digest of the shingle set (null where empty) and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(shingle)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                sizes, digests, bands, known = [], [], [], {}
                for text in b.column("text").to_pylist():
                    s = shingles(text)
                    sizes.append(len(s))
                    digest = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                    digests.append(digest)
                    if digest is not None and digest not in known:
                        known[digest] = band_keys(s).view(np.int64)
                    bands.append(known.get(digest))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("row"), pa.array(sizes, pa.int64()),
                     pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "row", "n_shingles", "digest", "bands"])

    return source.mapInArrow(run, SKETCH_SCHEMA.format(id=id_kind(source)))


def shingle_sets(source: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, data, size): the full shingle sets of the wanted (row, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last = Shingler(shingle), None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                nodes, data, sizes = [], [], []
                for node, text in zip(b.column("node").to_pylist(), b.column("text").to_pylist(), strict=True):
                    if node != last:  # repeated rows of one key follow one another
                        found = shingles(text)
                        nodes.append(node)
                        data.append(found.tobytes())
                        sizes.append(len(found))
                    last = node
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(data, pa.binary()), pa.array(sizes, pa.int64())],
                                                 names=["node", "data", "size"])

    # the wanted rows grow with the corpus, so they are never broadcast
    return source.select("row", "text").join(wanted.hint("merge"), "row").select("node", "text").mapInArrow(
        run, "node long, data binary, size long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per document: doc_id, row, n_shingles, component_id (lowest doc_id it reaches), kept, n_copies.

    Documents are linked if their sets of distinct ``shingle``-word shingles reach ``percent``
    Jaccard similarity; a shorter text is one shingle. Equal sets are one class from the start
    (``n_copies`` counts it), so copies cost one row; classes meet in band buckets, links are
    confirmed on full sets (``links.link``). Sets are compared by 64-bit shingle hashes.

    Null and empty texts have no shingles and link with nothing. A null id is no lowest id; a
    component of null ids has id null, and its rows are kept. Rows that repeat an id are linked
    by their texts, like others, and are kept if that id is the lowest. An empty table gives no
    rows; extra columns are ignored. ``row`` hashes id and text.
    """
    source = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    rows = materialize(sketches(source, shingle), "near-sketches")
    classes = materialize(
        rows.where("digest IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("low"), F.count("*").alias("n_copies"), F.min("row").alias("row"),
            F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "near-classes")
    members = shared_buckets(classes.select(F.explode("bands").alias("key"), "node"))
    nodes = members.select("node").distinct()
    wanted = materialize(classes.select("node", "row").join(nodes, "node", "left_semi"), "near-wanted")
    sets = materialize(shingle_sets(source, wanted, shingle), "near-sets")
    labels, _ = link(members, sets, lambda x: np.frombuffer(x, np.uint64), percent)
    rooted = classes.select("digest", "low", "n_copies", "node").join(labels, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    lows = materialize(rooted.groupBy("root").agg(F.min("low").alias("component"), F.count("*").alias("n")), "near-components")
    # classes of one document that link with nothing need no join
    target = materialize(
        rooted.join(lows, "root").where("n > 1 OR n_copies > 1").select("digest", "component", "n_copies"), "near-targets")
    grouped = F.col("n_copies").isNotNull()
    return rows.select("doc_id", "row", "n_shingles", "digest").join(target, "digest", "left").select(
        "doc_id", "row", "n_shingles",
        F.when(grouped, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(grouped, F.col("doc_id").eqNullSafe(F.col("component"))).otherwise(F.lit(True)).alias("kept"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"))
