"""Concatenate and cut: token sequences of fixed length from global prefix sums."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.common import id_and_text, id_kind, materialize
from riskspark.llm.tokens import word_coder

TOKENS_SCHEMA = "doc_id {id}, part int, before long, doc_tokens long, ids binary"
PIECES_SCHEMA = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
                 "sequence_id long, offset long, ids binary")


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """First pass: each document's ids, and the tokens before it within its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_coder(tokenizer_path)
        end = np.array([end_id], coder.dtype).tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                ids = [x + end for x in coder.encode(b.column("text").to_pylist())]
                n = np.array([len(x) // coder.dtype.itemsize for x in ids], np.int64)
                ends = before + np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(np.full(len(n), part, np.int32)),
                     pa.array(ends - n), pa.array(n), pa.array(ids, pa.binary())],
                    names=["doc_id", "part", "before", "doc_tokens", "ids"])
                before = int(ends[-1])

    return materialize(id_and_text(docs, id_col, text_col).mapInArrow(run, TOKENS_SCHEMA.format(id=id_kind(docs, id_col))), "pack-tokens")


def pack(docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document in a sequence: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset and the piece's ids (packed little-endian).

    The stream of all documents, each closed by ``end_id``, is cut every ``length`` tokens, so
    every sequence but the last is full. Pass one writes the ids with running sums inside each
    partition; the partition totals (one number per partition) are summed on the driver; pass
    two adds the two sums to the global position and cuts each document there. A piece with
    ``start`` above 0 or an end before ``doc_tokens`` is the boundary record of a cut document.

    A null or empty text is the single end id. Repeated rows are packed each; a null id stays
    null; an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    tokens = tokenize(docs, tokenizer_path, end_id, id_col, text_col)
    totals = sorted((r[0], r[1]) for r in tokens.groupBy("part").agg(F.sum("doc_tokens")).collect())
    base, rows = 0, []
    for part, total in totals:
        rows.append((part, base))
        base += total
    bases = spark.createDataFrame(rows, "part int, base long")
    width = word_coder(tokenizer_path).dtype.itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            names = ("doc_id", "position", "doc_tokens", "ids")
            for doc, position, total, packed in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                ids = np.frombuffer(packed, f"<u{width}").astype("<u4").tobytes()
                start = 0
                while start < total:
                    sequence, offset = divmod(position + start, length)
                    n = min(length - offset, total - start)
                    piece = ids[start * 4 : (start + n) * 4]
                    out.append((doc, start, n, zlib.crc32(piece), total, sequence, offset, piece))
                    start += n
                if len(out) >= 4096:
                    yield _pieces(out, batch.schema.field("doc_id").type)
                    out = []
            if out:
                yield _pieces(out, batch.schema.field("doc_id").type)

    # one row per partition of the first pass
    placed = tokens.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("position"), "doc_tokens", "ids")
    return placed.mapInArrow(cut, PIECES_SCHEMA.format(id=id_kind(docs, id_col)))


def _pieces(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, *[pa.int64()] * 6, pa.binary()]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ids and the documents in order.

    A group holds one sequence, so at most its fixed length of tokens.
    """
    part = F.struct("offset", "doc_id", "length", "ids")
    return (pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
            .select("sequence_id", F.expr("aggregate(p.length, 0L, (a, x) -> a + x)").alias("n_tokens"),
                    F.expr("aggregate(p.ids, X'', (a, x) -> concat(a, x))").alias("ids"),
                    F.col("p.doc_id").alias("doc_ids")))
