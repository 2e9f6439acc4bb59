"""Language-model scores by prediction by partial matching over byte contexts."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count
from math import log10

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskspark.llm.common import bucketed, materialize
from riskspark.llm.minhash import mix

ORDER = 5                 # bytes of the longest context; a context and its symbol fit 48 bits
LOCAL = 3                 # contexts that agree in so many last bytes are counted in one place
SYMBOLS = 256             # 255 is no byte of UTF-8: it stands before a text and ends it
EDGE = 255
BLOCK_DOCS = 65_536       # documents of one block, so that a gram and its document fit 64 bits
BLOCK_BYTES = 4_000_000   # text of one block, about
RANGE_BYTES = 64_000_000  # text whose contexts one range stands for, about

_DOC_BITS = np.uint64(16)


def byte_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(gram, document) of every byte and end of the texts: ``ORDER`` bytes before it, then itself."""
    edge = bytes([EDGE])
    raw = np.frombuffer(b"".join(edge * ORDER + t + edge for t in texts), np.uint8)
    gram = np.zeros(len(raw) - ORDER, np.uint64)
    for k in range(ORDER + 1):
        gram <<= np.uint64(8)
        gram |= raw[k : len(raw) - ORDER + k]
    # windows that end in the padding of the next text are none
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    keep = np.ones(len(gram), bool)
    starts = np.cumsum(sizes + ORDER)[:-1] - ORDER
    for k in range(ORDER):
        keep[starts + k] = False
    return gram[keep], np.repeat(np.arange(len(texts), dtype=np.uint16), sizes)


def counted_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, document, times), sorted; documents are numbered below ``BLOCK_DOCS``."""
    both, doc = byte_grams(texts)
    total = len(both)
    both <<= _DOC_BITS
    both |= doc
    both.sort()
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    starts = np.flatnonzero(new)
    both = both[starts]
    return both >> _DOC_BITS, (both & np.uint64(BLOCK_DOCS - 1)).astype(np.int64), np.diff(np.append(starts, total))


class Level:
    """Counts of one context length: sorted grams with their counts, and totals per context."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.grams, self.n = grams, n
        context = grams >> np.uint64(8)
        starts = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(grams) else np.empty(0, np.int64)
        self.contexts = context[starts]
        self.total = np.add.reduceat(n, starts) if len(starts) else n
        self.kinds = np.diff(np.append(starts, len(grams)))
        self.starts = starts

    def shorter(self, order: int) -> Level:
        """The counts of contexts of ``order`` bytes."""
        mask = np.uint64(2 ** (8 * (order + 1)) - 1)
        grams, at = np.unique(self.grams & mask, return_inverse=True)
        n = np.zeros(len(grams), np.int64)
        np.add.at(n, at, self.n)
        return Level(grams, n)


def _find(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted value, and whether it is there."""
    if not len(sorted_values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


def log_probabilities(grams: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 of each gram's last byte after the others; ``levels`` by falling context length, to 0.

    The longest context seen in training is asked first. A context with n occurrences of u symbols gives
    a symbol seen there its count out of n + u, and escapes to the next shorter one with u out of
    n + u. A shorter context leaves out the symbols of the longer one just escaped from: all that
    followed the longer one followed the shorter one too, so these are all that were excluded
    before. Where nothing is left the escape is certain. Below the empty context all symbols that training
    lacks are alike.
    """
    out = np.zeros(len(grams))
    todo = np.arange(len(grams))
    left_out = np.zeros(len(grams), np.int64)        # occurrences here of symbols already excluded
    excluded = np.zeros(len(grams), np.int64)        # their number
    for k, level in enumerate(levels):
        mask = np.uint64(2 ** (8 * (len(levels) - k)) - 1)
        g = grams[todo] & mask
        context, seen = _find(level.contexts, g >> np.uint64(8))
        place, hit = _find(level.grams, g)
        if len(level.contexts):
            total = np.where(seen, level.total[context] - left_out[todo], 0)
            kinds = np.where(seen, level.kinds[context] - excluded[todo], 0)
            out[todo[hit]] += np.log10(level.n[place[hit]] / (total[hit] + kinds[hit]))
            escape = ~hit & (kinds > 0)
            out[todo[escape]] += np.log10(kinds[escape] / (total[escape] + kinds[escape]))
            excluded[todo] = np.where(seen, level.kinds[context], 0)
            if k + 1 < len(levels):
                # the next context's occurrences of the symbols seen here
                below = levels[k + 1]
                there, _ = _find(below.grams, level.grams & (mask >> np.uint64(8)))
                gone = np.add.reduceat(below.n[there], level.starts)
                left_out[todo] = np.where(seen, gone[context], 0)
        todo = todo[~hit]
    out[todo] -= np.log10(np.maximum(SYMBOLS - excluded[todo], 1))
    return out


# ---- documents in blocks, and what they ask of the counts

_BLOCK_SCHEMA = "block long, at int, doc_id {id}, text binary, held_out boolean, place int, words binary, grams binary, ns binary"
_NAMES = ["block", "at", "doc_id", "text", "held_out", "place", "words", "grams", "ns"]


def _packed(values: np.ndarray) -> bytes:
    """Differences of sorted values, or plain numbers, as compressed bytes with their length."""
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), kind)


def _gram_places(grams: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each gram: by the last ``LOCAL`` bytes of its context."""
    near = (grams >> np.uint64(8)) & np.uint64(2 ** (8 * LOCAL) - 1)
    return ((mix(near + np.uint64(1)) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _word_places(words: list[bytes], ranges: int) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return ranges + ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _runs(place: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if not len(place):
        return
    starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    for a, b in zip(starts.tolist(), np.append(starts[1:], len(place)).tolist(), strict=True):
        yield int(place[a]), int(a), int(b)


def block_grams(texts: list[bytes], ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(grams, place) of a block's distinct grams, by place and gram, and per document and gram: the
    gram's number in that order, document, times."""
    gram, doc, times = counted_grams(texts)
    new = np.ones(len(gram), bool)
    new[1:] = gram[1:] != gram[:-1]
    distinct = gram[new]
    place = _gram_places(distinct, ranges)
    order = np.argsort(place, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return distinct[order], place[order], number[np.cumsum(new) - 1], doc, times


def block_words(texts: list[bytes], ranges: int) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
    """A block's distinct words by place and first appearance, their places, and per document the numbers of its
    words; the same for the same texts."""
    ids: defaultdict[bytes, int] = defaultdict(count().__next__)
    docs = []
    for t in texts:
        found = t.split()
        docs.append(np.fromiter(map(ids.__getitem__, found), np.int64, len(found)))
    words = list(ids)
    place = _word_places(words, ranges)
    order = np.argsort(place, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return [words[i] for i in order.tolist()], place[order], [number[d] for d in docs]


def _blocks(ranges: int, id_type: pa.DataType):
    """Rows of documents with their block, and rows of what each block holds per range: sorted grams, or
    words, and how often training documents of the block have them."""

    def rows(block: int, ids: list, texts: list[bytes], held: list[bool]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), id_type, pa.binary(), pa.bool_(), pa.int32(), *[pa.binary()] * 3]

        def batch(columns: dict[str, object], n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(_NAMES, kinds, strict=True)], names=_NAMES)

        n = len(ids)
        yield batch({"block": np.full(n, block), "at": np.arange(n, dtype=np.int32), "doc_id": ids, "text": texts, "held_out": held}, n)
        train = ~np.array(held)
        grams, place, number, doc, times = block_grams(texts, ranges)
        ns = np.bincount(number, weights=times * train[doc], minlength=len(grams)).astype("<u8")
        out = [(p, None, _packed(np.diff(grams[a:b], prepend=np.uint64(0))), _packed(ns[a:b])) for p, a, b in _runs(place)]
        words, place, docs = block_words(texts, ranges)
        trained = [d for d, here in zip(docs, train.tolist(), strict=True) if here]
        ns = np.bincount(np.concatenate([np.empty(0, np.int64), *trained]), minlength=len(words)).astype("<u8")
        out += [(p, _packed(np.frombuffer(b" ".join(words[a:b]), np.uint8)), None, _packed(ns[a:b])) for p, a, b in _runs(place)]
        for a in range(0, len(out), 100):
            part = out[a : a + 100]
            columns = dict(zip(("place", "words", "grams", "ns"), zip(*part, strict=True), strict=True))
            yield batch({"block": np.full(len(part), block), **columns}, len(part))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, texts, held, size = [], [], [], 0
        for b in batches:
            for doc, text, out in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "held_out")), strict=True):
                ids.append(doc)
                texts.append(text.encode().lower())
                held.append(out)
                size += len(texts[-1])
                if size >= BLOCK_BYTES or len(ids) == BLOCK_DOCS:
                    yield from rows(block, ids, texts, held)
                    block += 1
                    ids, texts, held, size = [], [], [], 0
        if ids:
            yield from rows(block, ids, texts, held)

    return run


def _short_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n) of the contexts shorter than ``LOCAL`` bytes, per row."""
    mask = np.uint64(2 ** (8 * LOCAL) - 1)
    for b in batches:
        for grams, ns in zip(b.column("grams").to_pylist(), b.column("ns").to_pylist(), strict=True):
            near = np.cumsum(_unpacked(grams, "<u8")) & mask
            kinds, at = np.unique(near, return_inverse=True)
            n = np.zeros(len(kinds), np.int64)
            np.add.at(n, at, _unpacked(ns, "<u8").astype(np.int64))
            some = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(kinds[some].astype(np.int64)), pa.array(n[some])], names=["gram", "n"])


def _answers(short: bytes, n_short: int):
    """What the counts of one range give back to each block: log probabilities of its grams, or the training
    counts of its words; ``fresh`` adds up the words that training has."""

    def run(table: pa.Table) -> pa.Table:
        blocks, place = table.column("block"), table.column("place")[0].as_py()
        ns = [_unpacked(x, "<u8").astype(np.int64) for x in table.column("ns").to_pylist()]
        if table.column("grams")[0].as_py() is not None:
            asked = [np.cumsum(_unpacked(x, "<u8")) for x in table.column("grams").to_pylist()]
            grams, at = np.unique(np.concatenate(asked), return_inverse=True)
            n = np.zeros(len(grams), np.int64)
            np.add.at(n, at, np.concatenate(ns))
            pairs = np.frombuffer(short, "<u8").reshape(2, n_short)
            level = Level(grams[n > 0], n[n > 0])
            levels = [level, *(level.shorter(k) for k in range(ORDER - 1, LOCAL - 1, -1))]
            low = Level(pairs[0], pairs[1].astype(np.int64))
            levels += [low, *(low.shorter(k) for k in range(LOCAL - 2, -1, -1))]
            found, kinds = log_probabilities(grams, levels).astype("<f4"), 0
        else:
            asked = [_unpacked(x, np.uint8).tobytes().split(b" ") for x in table.column("words").to_pylist()]
            number: defaultdict[bytes, int] = defaultdict(count().__next__)
            at = np.concatenate([np.fromiter(map(number.__getitem__, x), np.int64, len(x)) for x in asked])
            n = np.zeros(len(number), np.int64)
            np.add.at(n, at, np.concatenate(ns))
            found, kinds = n.astype("<u8"), int(np.count_nonzero(n))
        ends = np.cumsum([len(x) for x in asked])
        return pa.table({
            "block": blocks, "place": pa.array(np.full(len(asked), place, np.int32)),
            "values": pa.array([_packed(x) for x in np.split(found[at], ends[:-1])], pa.binary()),
            "kinds": pa.array([kinds] + [0] * (len(asked) - 1), pa.int64())})

    return run


def _scored(ranges: int, id_type: pa.DataType):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            raise RuntimeError("answers for a block that has no documents")
        docs = docs.sort_by("at")
        texts = docs.column("text").to_pylist()
        found = dict(zip(answers.column("place").to_pylist(), answers.column("values").to_pylist(), strict=True))
        values = [_unpacked(found[p], "<f4").astype(np.float64) for p in sorted(found) if p < ranges]
        _, _, number, doc, times = block_grams(texts, ranges)
        score = np.bincount(doc, weights=times * np.concatenate(values)[number], minlength=len(texts))
        _, _, words = block_words(texts, ranges)
        values = [np.empty(0, "<u8"), *(_unpacked(found[p], "<u8") for p in sorted(found) if p >= ranges)]
        n = np.concatenate(values).astype(np.float64)
        known, logs = n > 0, np.log10(n + 0.5)
        return pa.table({
            "doc_id": docs.column("doc_id").cast(id_type), "held_out": docs.column("held_out"),
            "n_words": pa.array([len(w) for w in words], pa.int64()),
            "known": pa.array([int(known[w].sum()) for w in words], pa.int64()),
            "logs": pa.array([float(logs[w].sum()) for w in words], pa.float64()), "score": pa.array(score)})

    return run


def ppm_scores(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the log10 probability of the text's bytes (A-Z lower-cased) and its end under a model that
    predicts each byte from the ``ORDER`` before it, pretrained on all documents where ``held_out`` is
    not true; see ``log_probabilities``. ``base_score`` is that of its words and one end under a
    unigram model of the same documents, smoothed by 0.5.

    Documents lie in blocks of bounded text. A block's distinct grams (a context and its symbol), with their counts in
    training documents, go to ranges of the context space, packed, once per block however frequent they are. All
    contexts that agree in their last ``LOCAL`` bytes meet in one range, which holds every count that
    escapes down to ``LOCAL`` bytes need; the counts of shorter contexts, at most 2^24 whatever the
    corpus, are known to all. Each range answers every block with one number of 32 bits per gram (seven
    digits), and blocks add them up. Words take the same way.

    A null text is empty: it has its end only. A null id counts as an empty text where ``held_out`` reads it. Repeated rows count
    each; without training documents all symbols are alike; an empty table gives no rows; other
    columns are ignored; ids may be of any type.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES + 1)
    schema = _BLOCK_SCHEMA.format(id=kind.simpleString())
    table = bucketed(source.mapInArrow(_blocks(ranges, id_type), schema), "block", "ppm", size)
    asked = table.where("place IS NOT NULL").select("block", "place", "words", "grams", "ns")
    held = table.where("at IS NOT NULL").select("block", "at", "doc_id", "text", "held_out")

    # at most 2^24 rows of two numbers
    short = (asked.where("grams IS NOT NULL").select("grams", "ns").mapInArrow(_short_counts, "gram long, n long")
             .groupBy("gram").agg(F.sum("n").alias("n")).toArrow())
    grams, n = (short.column(c).to_numpy() for c in ("gram", "n"))
    order = np.argsort(grams)
    tables = spark.sparkContext.broadcast(np.stack([grams[order], n[order]]).astype("<u8").tobytes())
    n_short = len(grams)
    answers = materialize(
        asked.groupBy("place").applyInArrow(lambda t: _answers(tables.value, n_short)(t), "block long, place int, values binary, kinds long"),
        "ppm-answers")
    kinds = answers.agg(F.sum("kinds")).first()[0] or 0
    schema = f"doc_id {kind.simpleString()}, held_out boolean, n_words long, known long, logs double, score double"
    scored = materialize(held.groupBy("block").cogroup(answers.select("block", "place", "values").groupBy("block")).applyInArrow(
        _scored(ranges, id_type), schema), "ppm-scored")
    ends, words = scored.where(~F.col("held_out")).agg(F.count("*"), F.sum("n_words")).first()
    train, distinct = ends + (words or 0), kinds + (1 if ends else 0)
    return scored.select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known") + (1 if ends else 0)).alias("n_known"), F.lit(train).cast("long").alias("train_tokens"),
        (F.col("logs") + log10(ends + 0.5) - (F.col("n_words") + 1) * log10(train + 0.5 * (distinct + 1))).alias("base_score"), "score")


def adaptive_log10(text: bytes, order: int = ORDER) -> float:
    """log10 probability of ``text`` and its end under a model that learns from the text itself, byte by
    byte, starting with nothing; the same escapes and exclusions."""
    history = bytes([EDGE]) * order
    counts: defaultdict[bytes, Counter] = defaultdict(Counter)
    total = 0.0
    for symbol in [*text, EDGE]:
        excluded: set[int] = set()
        for k in range(order, -1, -1):
            here = counts[history[order - k :]]
            left = {s: n for s, n in here.items() if s not in excluded}
            if not left:
                continue
            both = sum(left.values()) + len(left)
            if symbol in left:
                total += log10(left[symbol] / both)
                break
            total += log10(len(left) / both)
            excluded.update(left)
        else:
            total -= log10(SYMBOLS - len(excluded))
        for k in range(order + 1):
            counts[history[order - k :]][symbol] += 1
        history = (history + bytes([symbol]))[-order:] if order else b""
    return total


def adaptive_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and score: each document's ``adaptive_log10``, which needs no other document. A null text is empty."""
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [t.encode().lower() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(id_type), pa.array([len(t) for t in raw], pa.int64()),
                 pa.array([adaptive_log10(t) for t in raw], pa.float64())], names=["doc_id", "n_bytes", "score"])

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return source.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, score double")
