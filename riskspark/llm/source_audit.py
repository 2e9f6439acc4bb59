"""How the sources of each language differ: exact divergences of term distributions."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.llm.common import materialize

SCALE = 1_000_000_000     # probabilities are whole billionths
MIN_DOCS = 3              # documents of a language that a kept term is in
TOP_TERMS = 200           # reported terms of a source
RANGE_BYTES = 64_000_000  # text whose chunks one range of the hash space stands for, about
BATCH_BYTES = 8_000_000   # text counted at once

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_PLACES = "place int, data binary"
_U64 = pa.list_(pa.uint64())
_WORDS = pa.schema([("word", pa.binary()), ("codes", _U64), ("ns", _U64), ("langs", _U64), ("docs", _U64)])


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... within each run of equal keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    return np.arange(len(new)) - np.repeat(starts, np.diff(np.append(starts, len(new))))


def _summed(word: np.ndarray, code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts added up per word and code, sorted by both."""
    order = np.lexsort((code, word))
    word, code, n = word[order], code[order], n[order]
    first = _ranks(word, code) == 0
    starts = np.flatnonzero(first)
    return word[first], code[first], np.add.reduceat(n, starts) if len(starts) else n


def _few(word: np.ndarray, lang: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lowest ``MIN_DOCS`` distinct documents of each word and language. Unions of such short
    lists still tell exactly whether there are that many."""
    order = np.lexsort((doc, lang, word))
    word, lang, doc = word[order], lang[order], doc[order]
    first = _ranks(word, lang, doc) == 0
    word, lang, doc = word[first], lang[first], doc[first]
    few = _ranks(word, lang) < MIN_DOCS
    return word[few], lang[few], doc[few]


def _lists(word: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
    """One list per word 0 ... n - 1 from values sorted by word."""
    ends = np.searchsorted(word, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.uint64)))


def _placed(words: list[bytes], counts: tuple, docs: tuple, ranges: int) -> Iterator[pa.RecordBatch]:
    """Rows (place, data): the words of each range of the hash space with their lists, packed."""
    if not words:
        return
    n = len(words)
    table = pa.table([pa.array(words, pa.binary()), _lists(counts[0], counts[1], n), _lists(counts[0], counts[2], n),
                      _lists(docs[0], docs[1], n), _lists(docs[0], docs[2], n)], schema=_WORDS)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    place = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(place, kind="stable")
    place, table = place[order], table.take(pa.array(order))
    starts = np.flatnonzero(_ranks(place) == 0)
    blobs = []
    for a, b in zip(starts, np.append(starts[1:], n), strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _WORDS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table.slice(a, b - a).combine_chunks())
        blobs.append(sink.getvalue().to_pybytes())
    for a in range(0, len(starts), 64):
        yield pa.RecordBatch.from_arrays(
            [pa.array(place[starts[a : a + 64]], pa.int32()), pa.array(blobs[a : a + 64], pa.binary())], names=["place", "data"])


def _opened(blobs: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blobs]).combine_chunks()


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), sizes)


def _numbered(words: pa.ChunkedArray) -> tuple[np.ndarray, list[bytes]]:
    """The number of each row's word, and the distinct words."""
    coded = words.combine_chunks().dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def _chunks(ranges: int):
    """First pass: white-space chunks counted per document, added up over the documents of a batch."""

    def counted(codes: np.ndarray, texts: list[str], first_doc: int) -> Iterator[pa.RecordBatch]:
        ids: defaultdict[bytes, int] = defaultdict(count().__next__)
        pairs = [np.empty(0, np.int64)]
        for d, text in enumerate(texts):
            found = text.encode().lower().split()
            pairs.append(np.fromiter(map(ids.__getitem__, found), np.int64, len(found)) + (d << 32))
        both, n = np.unique(np.concatenate(pairs), return_counts=True)
        doc, word = both >> 32, both & 0xFFFFFFFF
        code = codes[doc]
        docs = _few(word, code >> np.uint64(32), (doc + first_doc).astype(np.uint64))
        yield from _placed(list(ids), _summed(word, code, n), docs, ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc = TaskContext.get().partitionId() << 40
        for batch in batches:
            codes = batch.column("code").to_numpy().view(np.uint64)
            texts, start, held = [], 0, 0
            for i, text in enumerate(batch.column("text").to_pylist()):
                texts.append(text)
                held += len(text)
                if held >= BATCH_BYTES or i + 1 == batch.num_rows:
                    yield from counted(codes[start : i + 1], texts, doc + start)
                    texts, start, held = [], i + 1, 0
            doc += batch.num_rows

    return run


def _chunk_terms(ranges: int):
    """Second pass, per range of chunks: every distinct chunk is taken apart once, and its terms get
    its counts and documents."""

    def run(groups: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        for group in groups:
            table = _opened(group.column("data").to_pylist())
            chunk_of, chunks = _numbered(table.column("word"))
            terms: defaultdict[str, int] = defaultdict(count().__next__)
            chunk, term, times = [], [], []
            for c, raw in enumerate(chunks):
                found = _TERM.findall(raw.decode())
                for t, n in (Counter(found) if len(found) > 1 else dict.fromkeys(found, 1)).items():
                    chunk.append(c)
                    term.append(terms[t])
                    times.append(n)
            owners = np.array(chunk, np.int64)
            starts = np.searchsorted(owners, np.arange(len(chunks) + 1))
            term, times = np.array(term, np.int64), np.array(times, np.uint64)

            def joined(column: str) -> tuple[np.ndarray, ...]:
                """Values of a list column, once per term of their chunk."""
                values, row = _flat(table.column(column))
                c = chunk_of[row]
                n = starts[c + 1] - starts[c]
                at = np.repeat(starts[c], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                return np.repeat(values, n), term[at], times[at], np.repeat(np.arange(len(values)), n)

            codes, word, times_of, place = joined("codes")
            ns = _flat(table.column("ns"))[0][place]
            langs, doc_word, _, at = joined("langs")
            docs = _flat(table.column("docs"))[0][at]
            yield from _placed([t.encode() for t in terms], _summed(word, codes, ns * times_of), _few(doc_word, langs, docs), ranges)

    return run


def _kept_counts(groups: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    """Third pass, per range of terms: occurrences per source of the terms that enough documents of
    the language hold."""
    for group in groups:
        table = _opened(group.column("data").to_pylist())
        term_of, terms = _numbered(table.column("word"))
        (codes, row), (ns, _) = _flat(table.column("codes")), _flat(table.column("ns"))
        (langs, doc_row), (docs, _) = _flat(table.column("langs")), _flat(table.column("docs"))
        word, code, n = _summed(term_of[row], codes, ns)
        doc_word, lang, _ = _few(term_of[doc_row], langs, docs)
        enough = _ranks(doc_word, lang) == MIN_DOCS - 1
        high = np.uint64(32)
        kept = (doc_word[enough].astype(np.uint64) << high) | lang[enough]
        keep = np.isin((word.astype(np.uint64) << high) | (code >> high), kept)
        names = pa.array(terms, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(code[keep].view(np.int64)), names.take(pa.array(word[keep])), pa.array(n[keep].astype(np.int64))],
            names=["code", "term", "n"])


def _applied(rows: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over the packed rows of each place."""

    def one(table: pa.Table) -> pa.Table:
        out = list(run(iter([table])))
        return pa.Table.from_batches(out) if out else empty

    empty = pa.table({"place": pa.array([], pa.int32()), "data": pa.array([], pa.binary())})
    return rows.groupBy("place").applyInArrow(one, schema)


def share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * n / total) in whole numbers, by long division in steps of three digits, so that
    no product leaves 64 bits below 9e15 tokens; null where the total is 0."""
    total = F.when(total > 0, total)
    whole, rest = F.call_function("div", n, total), n % total
    for _ in range(3):
        whole = whole * 1000 + F.call_function("div", rest * 1000, total)
        rest = (rest * 1000) % total
    return whole + 1


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def kept_terms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(groups, counts): groups has code, lang and source of every occurring pair, counts has code,
    term and the occurrences there of each kept term of the language.

    Texts are cut at ASCII white space, which no term spans; chunks are counted per document, added
    up per batch of documents, and meet in ranges of the hash space, where each distinct chunk is
    taken apart into terms once. Terms with the counts and the first documents of their chunks meet
    in ranges again. Rows travel packed, a word once per batch, however frequent it is.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lang, source = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (lang_col, source_col))
    base = docs.select(lang.alias("lang"), source.alias("source"), text.alias("text"))
    names = materialize(base.groupBy("lang", "source").agg(F.sum(F.octet_length("text")).cast("long").alias("bytes")), "audit-names")
    total = names.agg(F.sum("bytes")).first()[0] or 0
    for seed in range(100):
        low = F.xxhash64(F.lit(seed), F.lit(1), "lang", "source").bitwiseAND(0xFFFFFFFF)
        code = F.shiftleft(F.xxhash64(F.lit(seed), "lang"), 32).bitwiseOR(low)
        groups = names.select(code.alias("code"), "lang", "source")
        n, codes, langs, highs = groups.agg(
            F.count("*"), F.countDistinct("code"), F.countDistinct("lang"), F.countDistinct(F.shiftright("code", 32))).first()
        if (n, langs) == (codes, highs):
            break
    else:
        raise ValueError("too many sources of one language to number them by 32 bits")
    ranges = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE_BYTES + 1)
    chunks = base.select(code.alias("code"), "text").mapInArrow(_chunks(ranges), _PLACES)
    terms = _applied(chunks, _chunk_terms(ranges), _PLACES)
    counts = materialize(
        terms.groupBy("place").applyInArrow(lambda t: pa.Table.from_batches(list(_kept_counts(iter([t])))), "code long, term string, n long"),
        "audit-counts")
    return groups, counts


def source_audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how each source differs from the others of its language.

    Terms are runs of letters (ASCII letters lower-cased, all characters from U+0080); a language
    keeps the terms that at least ``MIN_DOCS`` of its documents hold, V in number. A source, or a language, gives
    a kept term the probability p = 1 + floor(SCALE * (n + 1) / (N + V)), n its occurrences there, N those
    of all kept terms. Part ``pair`` ranks the other sources of the language by the sum over all kept
    terms of floor((p - q)^2 / q); part ``term`` the first ``TOP_TERMS`` terms that the source uses more
    than its language does. Ties go by the item in byte order.

    A pair's sum is taken apart: terms that neither source has are alike, terms of one source alone
    depend on their count only and are added up per count, and only terms of both meet, by a join on the
    term, whose rows are at most the squared number of sources of each term.

    Null texts, languages and sources count as empty strings; each row is a document of its own, so
    repeated rows count again; a language without kept terms has pairs of value 0; an empty table gives no
    rows; other columns are ignored.
    """
    groups, counts = kept_terms(docs, text_col, lang_col, source_col)
    # one row per source
    groups = groups.join(counts.groupBy("code").agg(F.sum("n").alias("total"), F.count("*").alias("own")), "code", "left").select(
        "code", "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("own", F.lit(0)).alias("own"))
    named = counts.join(groups.select("code", "lang"), "code")
    whole = materialize(named.groupBy("lang", "term").agg(F.sum("n").alias("lang_n")), "audit-terms")
    langs = whole.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = groups.join(langs, "lang", "left").fillna(0, ["v", "lang_total"])
    groups = materialize(groups.withColumn("p0", share(F.lit(1), F.col("total") + F.col("v"))), "audit-groups")

    shares = materialize(
        counts.join(groups, "code").join(whole, ["lang", "term"]).select(
            "lang", "term", "code", "source", "p0", share(F.col("n") + 1, F.col("total") + F.col("v")).alias("p"),
            share(F.col("lang_n") + 1, F.col("lang_total") + F.col("v")).alias("q")), "audit-shares")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = (shares.where("p > q").select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
           .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS))

    def side(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
        return df.select("lang", *[F.col(c).alias(f"{prefix}{c}") for c in columns])

    # a row per two sources of a language, as in the result
    pairs = side(groups, "a_", "code", "source", "p0", "own", "v").join(side(groups, "b_", "code", "source", "p0", "own"), "lang").where(
        "a_code <> b_code")
    sizes = shares.groupBy("lang", "code", "p").agg(F.count("*").alias("k"))
    others = side(groups, "o_", "code", "p0")
    alone = sizes.join(others, "lang").where("code <> o_code")
    only_a = alone.groupBy("code", "o_code").agg(F.sum(divergence(F.col("p"), F.col("o_p0")) * F.col("k")).alias("only_a"))
    only_b = alone.groupBy("code", "o_code").agg(F.sum(divergence(F.col("o_p0"), F.col("p")) * F.col("k")).alias("only_b"))
    left = shares.select("lang", "term", F.col("code").alias("a_code"), F.col("p").alias("a"), F.col("p0").alias("a0"))
    right = shares.select("lang", "term", F.col("code").alias("b_code"), F.col("p").alias("b"), F.col("p0").alias("b0"))
    both = left.join(right, ["lang", "term"]).where("a_code <> b_code").groupBy("a_code", "b_code").agg(
        F.sum(divergence(F.col("a"), F.col("b")) - divergence(F.col("a"), F.col("b0")) - divergence(F.col("a0"), F.col("b"))).alias("both"),
        F.count("*").alias("n_both"))
    none = F.col("a_v") - F.col("a_own") - F.col("b_own") + F.coalesce("n_both", F.lit(0))
    value = sum((F.coalesce(c, F.lit(0)) for c in ("only_a", "only_b", "both")), F.coalesce(
        none * divergence(F.col("a_p0"), F.col("b_p0")), F.lit(0)))
    pair = (pairs.join(both, ["a_code", "b_code"], "left")
            .join(only_a.toDF("a_code", "b_code", "only_a"), ["a_code", "b_code"], "left")
            .join(only_b.toDF("b_code", "a_code", "only_b"), ["a_code", "b_code"], "left")
            .select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), value.alias("value"))
            .withColumn("rank", F.row_number().over(order)))
    return pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        top.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
