"""Cross-tokenizer alignment through an inverted index of linked id pairs."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from riskspark.llm.common import materialize
from riskspark.llm.tokens import BYTE_LEVEL_PATTERN, LONG_RUN, _byte_of_char, _ranks

MEMO_UNITS = 250_000        # space-separated units remembered per worker, and their characters;
MEMO_CHARS = 6_000_000      # the memory starts again beyond either
LEARNED_AT_ONCE = 4_000     # units encoded by one call
BLOCK_DOCS = 65_536         # document numbers of one bitmap container
BLOCK_BYTES = 10_000_000    # text of one block, about
DENSE = 4_096               # documents from which a container is a bitmap instead of a list
BASE = -1                   # the plane of all documents that hold a pair

_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


class Aligned(NamedTuple):
    """What a text, or a unit of one, gives: the groups as text, the linked pairs, and numbers of ids."""

    groups: bytes
    pairs: bytes
    n_a: int
    n_b: int


# A space beside white space or an end: the text is not cut at its spaces.
_UNEVEN = re.compile(r"\A\x20|\x20\Z|\s\x20|\x20\s")


class PairCoder:
    """Both tokenizations of a text and their alignment, equal to those of the two libraries.

    Where the vocabularies are of the known shapes (byte-level BPE; pieces in which the space mark
    only leads), no token of either side runs over a single space between other characters than white
    space, so both sides end there: texts that hold no other spaces are cut at them, and each distinct unit
    is encoded and aligned once while remembered, many units in one call. All other texts go to the
    libraries whole.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        byte_of = _byte_of_char()
        vocab = spec["model"]["vocab"]
        self.a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if t not in special}
        self.a_size = self._sizes(self.a_bytes)
        self.b_bytes = {i: self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())}
        self.b_size = self._sizes(self.b_bytes)
        pre = spec["pre_tokenizer"] or {}
        self.fast = None
        if (spec["model"]["type"] == "BPE" and spec["normalizer"] is None and spec["post_processor"] is None
                and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                and not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in self.b_bytes)):
            ranks = _ranks({t: i for t, i in vocab.items() if t not in special})
            self.fast = tiktoken.Encoding("from-file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.memo: dict[str, Aligned | None] = {}
        self.chars = 0

    @staticmethod
    def _sizes(token_bytes: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(max(token_bytes) + 1, np.int64)
        for i, raw in token_bytes.items():
            out[i] = len(raw)
        return out

    @staticmethod
    def _piece(piece: str) -> bytes:
        m = _BYTE_PIECE.fullmatch(piece)
        return bytes([int(m[1], 16)]) if m else piece.replace("▁", " ").encode()

    def _aligned(self, raw: bytes, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> list[Aligned] | None:
        """The parts of ``raw`` that end at ``ends``, which both sides must reach; None where a side does
        not give the bytes back."""
        for known, ids in ((self.a_bytes, a), (self.b_bytes, b)):
            if b"".join(map(known.get, ids.tolist(), repeat(b""))) != raw:
                return None
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        # token ends only grow, so a common end is one token of either side
        common, i, j = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        pairs = ((a[i].astype(np.int64) << 32) | b[j].astype(np.int64)).tobytes()
        left, right = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups, x, y = [], 0, 0
        for p, q in zip((i + 1).tolist(), (j + 1).tolist(), strict=True):
            groups.append(f"{left[x] if p == x + 1 else ','.join(left[x:p])}|{right[y] if q == y + 1 else ','.join(right[y:q])}")
            x, y = p, q
        last = np.searchsorted(common, ends)
        if len(ends) and (last[-1] >= len(common) or (common[last] != ends).any()):
            raise RuntimeError("a token runs over a space")
        upto = (last + 1).tolist()
        n_a, n_b = np.diff(i[last] + 1, prepend=0).tolist(), np.diff(j[last] + 1, prepend=0).tolist()
        return [Aligned(";".join(groups[s:e]).encode(), pairs[8 * s : 8 * e], n, m)
                for s, e, n, m in zip([0, *upto[:-1]], upto, n_a, n_b, strict=True)]

    def whole(self, text: str) -> Aligned | None:
        """The alignment of one text by the libraries themselves."""
        if not text:
            return None
        raw = f" {text}"
        found = self._aligned(raw.encode(), np.array(self.a.encode(raw, add_special_tokens=False).ids, np.int64),
                              np.array(self.b.encode(text, num_threads=1), np.int64), np.array([len(raw.encode())]))
        return found and found[0]

    def _learn(self, units: list[str]) -> None:
        """Align new units, as one text of all that keep their bytes."""
        self.chars += sum(map(len, units))
        plain = [u for u in units if len(u) < LONG_RUN and "▁" not in u]
        for u in set(units).difference(plain):
            self.memo[u] = self.whole(u)
        if not plain:
            return
        raw = " " + " ".join(plain)
        ends = np.cumsum(np.fromiter((len(u.encode()) for u in plain), np.int64, len(plain)) + 1)
        found = self._aligned(raw.encode(), self.fast.encode_to_numpy(raw, disallowed_special=()).astype(np.int64),
                              np.array(self.b.encode(raw[1:], num_threads=1), np.int64), ends)
        if found is None:  # some unit does not give its bytes back
            found = [self.whole(u) for u in plain]
        self.memo.update(zip(plain, found, strict=True))

    def align(self, texts: list[str]) -> list[list[Aligned] | None]:
        """Per text its aligned parts in order, or None where it has no tokens."""
        if len(self.memo) > MEMO_UNITS or self.chars > MEMO_CHARS:
            self.memo.clear()
            self.chars = 0
        cut = [None if self.fast is None or not t or _UNEVEN.search(t) else t.split(" ") for t in texts]
        new = list(set(chain.from_iterable(u for u in cut if u)).difference(self.memo))
        for at in range(0, len(new), LEARNED_AT_ONCE):
            self._learn(new[at : at + LEARNED_AT_ONCE])
        out: list[list[Aligned] | None] = []
        for text, units in zip(texts, cut, strict=True):
            parts = list(map(self.memo.__getitem__, units)) if units else [self.whole(text)]
            out.append(None if None in parts else parts)
        return out


@lru_cache(maxsize=2)
def pair_coder(a_path: str, b_path: str) -> PairCoder:
    """One coder per worker process, so that tasks that follow one another share its memory."""
    return PairCoder(a_path, b_path)


def containers(pairs: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
    """(pair, plane, bits): compressed document bitmaps of the links of one block, given as sorted
    parallel arrays with one entry per link.

    The plane ``BASE`` of a pair holds every document that has it; plane k those in which bit k of the
    number of its further links is set, so popcounts weighted by 2^k give the links. A container of
    few documents lists them in two bytes each, a larger one is a bitmap of ``BLOCK_DOCS`` bits.
    """
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]) | (docs[1:] != docs[:-1])
    starts = np.flatnonzero(new)
    more = np.diff(np.append(starts, len(pairs))) - 1
    pair, doc = pairs[starts], docs[starts]
    out_pair, out_plane, bits = [], [], []
    planes = [(BASE, np.ones(len(pair), bool))]
    planes += [(k, (more >> k) & 1 == 1) for k in range(int(more.max(initial=0)).bit_length())]
    for plane, chosen in planes:
        p, d = pair[chosen], doc[chosen].astype("<u2")
        if not len(p):
            continue
        first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        ends = np.append(first[1:], len(p)).astype(np.int64)
        raw = d.tobytes()
        for a, b in zip(first.tolist(), ends.tolist(), strict=True):
            if b - a < DENSE:
                bits.append(raw[2 * a : 2 * b])
            else:
                dense = np.zeros(BLOCK_DOCS, np.uint8)
                dense[d[a:b]] = 1
                bits.append(np.packbits(dense, bitorder="little").tobytes())
        out_pair.append(p[first])
        out_plane.append(np.full(len(first), plane, np.int32))
    return np.concatenate(out_pair), np.concatenate(out_plane), pa.array(bits, pa.binary())


def documents_of(bits: bytes) -> np.ndarray:
    """The document numbers of a container."""
    if len(bits) < BLOCK_DOCS // 8:
        return np.frombuffer(bits, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


INDEX_SCHEMA = ("block long, at int, doc_id {id}, n_a long, n_b long, n_groups long, groups_sha256 string, "
                "pair long, plane int, bits binary")
_DOC = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]


def _index(a_path: str, b_path: str, id_type: pa.DataType):
    """Rows of documents and rows of containers, block by block."""

    def block_rows(block: int, rows: list[tuple], links: list[bytes], sizes: list[int]) -> Iterator[pa.RecordBatch]:
        n = len(rows)
        columns = list(zip(*rows, strict=True))
        kinds = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.string()]
        docs = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        names = ["block", "at", *_DOC, "pair", "plane", "bits"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), *docs,
             pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        pairs = np.frombuffer(b"".join(links), np.int64)
        if not len(pairs):
            return
        distinct, number = np.unique(pairs, return_inverse=True)
        both = np.sort(number * BLOCK_DOCS + np.repeat(np.arange(n), sizes))
        pair, plane, bits = containers(distinct[both // BLOCK_DOCS], both % BLOCK_DOCS)
        m = len(pair)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, block)), pa.nulls(m, pa.int32()), *(pa.nulls(m, t) for t in kinds),
             pa.array(pair), pa.array(plane), bits], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pair_coder(a_path, b_path)
        block = TaskContext.get().partitionId() << 32
        rows, links, sizes, held = [], [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                texts = b.column("text").to_pylist()
                for doc, text, parts in zip(b.column("doc_id").to_pylist(), texts, coder.align(texts), strict=True):
                    if parts is None:
                        rows.append((doc, 0, 0, 0, ""))
                        sizes.append(0)
                    else:
                        pairs = b"".join([p.pairs for p in parts])
                        groups = b";".join([p.groups for p in parts])
                        rows.append((doc, sum(p.n_a for p in parts), sum(p.n_b for p in parts), len(pairs) // 8,
                                     hashlib.sha256(groups).hexdigest()))
                        links.append(pairs)
                        sizes.append(len(pairs) // 8)
                    held += len(text)
                    if held >= BLOCK_BYTES or len(rows) == BLOCK_DOCS:
                        yield from block_rows(block, rows, links, sizes)
                        block += 1
                        rows, links, sizes, held = [], [], [], 0
        if rows:
            yield from block_rows(block, rows, links, sizes)

    return run


def alignment_index(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, postings), written once.

    ``documents``: block, at, doc_id, n_a, n_b, n_groups, groups_sha256. ``postings``: pair (first id
    x 2^32 + second), block, plane, bits; see ``containers``.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    index = materialize(source.mapInArrow(
        _index(a_path, b_path, to_arrow_type(kind)), INDEX_SCHEMA.format(id=kind.simpleString())), "alignment-index")
    return (index.where("at IS NOT NULL").select("block", "at", *_DOC),
            index.where("pair IS NOT NULL").select("pair", "block", "plane", "bits"))


def pair_counts(postings: DataFrame) -> DataFrame:
    """pair, a, b, n_docs, n_links, best: whether no other pair of its second id has more links.

    Containers of different blocks hold different documents, so their popcounts add up.
    """
    n = F.when(F.length("bits") < BLOCK_DOCS // 8, (F.length("bits") / 2).cast("long")).otherwise(F.bitmap_count("bits"))
    base = F.col("plane") == BASE
    weight = F.when(base, F.lit(1).cast("long")).otherwise(F.expr("shiftleft(1L, greatest(plane, 0))"))
    totals = postings.groupBy("pair").agg(
        F.sum(F.when(base, n).otherwise(0)).alias("n_docs"), F.sum(n * weight).alias("n_links")).select(
        "pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n_docs", "n_links")
    totals = materialize(totals, "alignment-pairs")
    most = totals.groupBy("b").agg(F.max("n_links").alias("most"))
    return totals.join(most, "b").select("pair", "a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def _scores(table: pa.Table) -> pa.Table:
    """What the postings of one block give back to its documents."""
    n_best, total = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
    held = np.zeros(BLOCK_DOCS, bool)
    plane = np.maximum(table.column("plane").to_numpy(), 0)
    size = np.empty(table.num_rows, np.int64)
    found = []
    for k, bits in enumerate(table.column("bits").to_pylist()):
        found.append(documents_of(bits))
        size[k] = len(found[-1])
    at = np.concatenate(found).astype(np.int64)
    weight = np.repeat(np.int64(1) << plane.astype(np.int64), size)
    np.add.at(total, at, weight * np.repeat(table.column("n_links").to_numpy(), size))
    np.add.at(n_best, at, weight * np.repeat(table.column("best").to_numpy(zero_copy_only=False), size))
    held[at] = True
    at = np.flatnonzero(held)
    return pa.table({"block": np.full(len(at), table.column("block")[0].as_py()), "at": at.astype(np.int32),
                     "n_best": n_best[at], "count_sum": total[at]})


def cross_alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A space and the text are encoded by the byte-level file (A), the text by the piece model (B), which
    adds that space, both without special tokens. Byte offsets where tokens of both sides end cut the
    tokens into groups; the A and the B token that end there are linked. The links are inverted: per pair
    of ids and block of documents a compressed bitmap of the documents, and planes for repeated
    links in one document. Popcounts give each pair's links over the corpus; the postings, joined
    to these counts, return them to the documents, block by block: n_best links whose pair has the
    most links of its B id (ties included), count_sum the counts added up over the links.

    Null and empty texts, and texts that a side doesn't give back byte for byte, have no tokens: zeros
    and an empty groups_sha256. Repeated rows count each; ids may be of any type and null; an empty
    table gives no rows; extra columns are ignored.
    """
    documents, postings = alignment_index(docs, a_path, b_path, id_col, text_col)
    counts = pair_counts(postings).select("pair", "n_links", "best")
    # both sides grow with the vocabularies or the corpus, so neither is sent whole
    scored = postings.join(counts.hint("merge"), "pair").select("block", "plane", "bits", "n_links", "best")
    scores = scored.groupBy("block").applyInArrow(_scores, "block long, at int, n_best long, count_sum long")
    return documents.join(scores, ["block", "at"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
