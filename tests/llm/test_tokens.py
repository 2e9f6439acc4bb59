import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from riskspark.llm.packing import pack, sequences
from riskspark.llm.token_cache import token_counts
from riskspark.llm.tokens import WordCoder, byte_level_counter

DDL = "doc_id long, text string, digest string, row long, part int, ids string"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def odd_texts(n=1500):
    rng = random.Random(1)
    letters = "aAbÉéßſK İıΣσς\t\n\r \x0b\x0c\x1c\x85\xa0 　 0192½²'sSrReL<|>!?.,;-_$€😀́‍\x00"
    parts = ["<|endoftext|>", "<|startoftext|>", " <|endoftext|> ", "  ", "\n\n", " the", "don't", "I'LL", "ẞ", "ﬁ", "가", "x" * 40]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.2 else rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return texts + ["a" * 6000, " " * 20_000, "ab " * 5000, "\n" * 5000 + "x", "é" * 7000, "!" * 20_000, "x" * 4999, ""]


@pytest.fixture(scope="module")
def texts():
    return odd_texts() + pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()


def test_counts_equal_the_library(texts):
    exact, count = Tokenizer.from_file(BYTES), byte_level_counter(BYTES)
    for t in texts:
        assert count(t) == len(exact.encode(t, add_special_tokens=False).ids), repr(t[:60])


def test_ids_equal_the_library(texts):
    exact, coder = Tokenizer.from_file(WORDS), WordCoder(WORDS)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for t, ids in zip(part, coder.encode(part), strict=True):
            assert np.frombuffer(ids, coder.dtype).tolist() == exact.encode(t, add_special_tokens=False).ids, repr(t[:60])


def test_cache_encodes_only_misses(spark, tmp_path):
    exact = Tokenizer.from_file(BYTES)
    first = [(1, "one two"), (2, "one two"), (3, None), (4, ""), (None, "three"), (4, "")]
    make = lambda rows: spark.createDataFrame([(i, t, "d", 1, 2, "x") for i, t in rows], DDL)
    cache = str(tmp_path / "cache")
    got = token_counts(make(first), cache, BYTES, max_tokens=1).collect()
    want = [(i, len((t or "").encode()), len(exact.encode(t or "").ids), len(exact.encode(t or "").ids) > 1, False) for i, t in first]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert spark.read.parquet(cache).count() == 3
    again = token_counts(make([(9, "three"), (10, "new text")]), cache, BYTES).collect()
    assert {r.doc_id: r.cached for r in again} == {9: True, 10: False}
    assert spark.read.parquet(cache).count() == 4
    assert token_counts(make([]), cache, BYTES).count() == 0
    # another version of the tokenizer does not see these counts
    other = token_counts(make([(1, "one two")]), cache, WORDS).collect()
    assert [r.cached for r in other] == [False]


@pytest.mark.parametrize("length", [7, 2048])
def test_packing_round_trip(spark, length):
    exact = Tokenizer.from_file(WORDS)
    rows = [(i, t) for i, t in enumerate(odd_texts(120)[:-8])] + [(500, None), (501, ""), (None, "a b"), (7, "same"), (7, "same")]
    df = spark.createDataFrame([(i, t, "d", 1, 2, "x") for i, t in rows], DDL).repartition(5)
    pieces = pack(df, WORDS, length)
    found = pieces.orderBy("sequence_id", "offset").collect()
    want = sorted(np.array([*exact.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for _, t in rows)
    # gapless sequences, all full but the last
    at = 0
    for p in found:
        assert (p.sequence_id, p.offset) == divmod(at, length) and 0 < p.length <= length - p.offset
        assert p.ids_crc32 == zlib.crc32(bytes(p.ids)) and len(p.ids) == 4 * p.length
        at += p.length
    # pieces of one document follow one another in the stream
    whole, got = b"", []
    for p in found:
        assert p.start == len(whole) // 4
        whole += bytes(p.ids)
        if len(whole) == 4 * p.doc_tokens:
            got.append(whole)
            whole = b""
    assert sorted(got) == want and whole == b""
    full = sequences(pieces).orderBy("sequence_id").collect()
    assert b"".join(bytes(s.ids) for s in full) == b"".join(bytes(p.ids) for p in found)
    assert all(s.n_tokens == length for s in full[:-1])


def test_packing_nothing(spark):
    assert pack(spark.createDataFrame([], DDL), WORDS).count() == 0
