import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskspark.llm.alignment import (BASE, DENSE, PairCoder, alignment_index, containers, cross_alignment, documents_of,
                                     pair_counts)
from riskspark.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


class Plain:
    """Token ends one by one, straight from the two libraries."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        self.byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def tokens(self, text):
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            is_byte = len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")
            b.append((i, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
        return a, b

    def aligned(self, text):
        """(ids of A, ids of B, groups, links) or None."""
        if not text:
            return None
        a, b = self.tokens(text)
        raw = (" " + text).encode()
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            return None
        i = j = end_a = end_b = 0
        groups, links, left, right = [], [], [], []
        while i < len(a) or j < len(b):
            if end_a <= end_b:
                end_a += len(a[i][1])
                left.append(a[i][0])
                i += 1
            else:
                end_b += len(b[j][1])
                right.append(b[j][0])
                j += 1
            if end_a == end_b and left and right:
                links.append((left[-1], right[-1]))
                groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
                left, right = [], []
        return a, b, groups, links


def brute(rows):
    plain = Plain()
    found = [(i, plain.aligned(t)) for i, t in rows]
    count = Counter(x for _, f in found if f for x in f[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        out.append((i, len(a), len(b), len(groups), len(links), sum(count[x] == most[x[1]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out, count


def odd_texts(n=1200):
    rng = random.Random(12)
    letters = "aAbÉéßſK İıΣς\t\n\r \x0b\x0c\x1c\x85\xa0 　 0192½²'sSrR<|>!?.,;-_$€😀́‍\x00▁{}();/*"
    parts = ["<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "  ", " the", " don't", "가나", " x", "\r\n", ");\r", " \n ", "x" * 40, " a", " b"]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.3 else rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return texts + ["a" * 6000 + " b", " lead", "trail ", "one  two", "x▁y z", "plain words only", "", "ab " * 3000 + "end", "é" * 3000]


def test_parts_equal_the_libraries():
    coder, plain = PairCoder(A, B), Plain()
    texts = odd_texts() + pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()
    cut = 0
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        for text, found in zip(part, coder.align(part), strict=True):
            want = plain.aligned(text)
            assert (found is None) == (want is None), repr(text[:80])
            if want is None:
                continue
            cut += len(found) > 1
            a, b, groups, links = want
            assert b";".join(p.groups for p in found).decode() == ";".join(groups), repr(text[:80])
            assert (sum(p.n_a for p in found), sum(p.n_b for p in found)) == (len(a), len(b))
            pairs = np.frombuffer(b"".join(p.pairs for p in found), np.int64)
            assert list(zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist(), strict=True)) == links
    assert cut > 300  # the shorter way is taken and right


def test_containers_hold_documents_and_repeats():
    rng = np.random.default_rng(2)
    pairs = rng.choice([7, 2**40 + 3, 5], 60_000, p=[0.9, 0.08, 0.02])
    docs = rng.integers(0, 9_000, 60_000)
    order = np.lexsort((docs, pairs))
    count = Counter(zip(pairs.tolist(), docs.tolist(), strict=True))
    got, dense = Counter(), 0
    for pair, plane, bits in zip(*(x.tolist() for x in containers(pairs[order], docs[order])[:2]),
                                 containers(pairs[order], docs[order])[2].to_pylist(), strict=True):
        found = documents_of(bits).tolist()
        dense += len(found) >= DENSE
        assert found == sorted(set(found))
        for d in found:
            got[pair, d] += 1 if plane == BASE else 1 << plane
    assert got == count and dense > 1


DDL = "doc_id {}, text string, block long, at int, pair long, bits string"


@pytest.mark.parametrize("kind", ["long", "string"])
def test_scores_equal_brute_force(spark, kind):
    texts = odd_texts(60) + ["the cat the cat the cat", "the cat", "the cat", None, "", "the dog " * 700 + "end"]
    ids = [i if kind == "long" else f"d{i}" for i in range(len(texts))]
    ids[5] = None
    rows = list(zip(ids, texts, strict=True)) + [(ids[3], texts[3])]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in rows], DDL.format(kind)).repartition(3)
    want, count = brute(rows)
    got = cross_alignment(docs, A, B).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    pairs = pair_counts(alignment_index(docs, A, B)[1]).collect()
    assert {(r.a, r.b): r.n_links for r in pairs} == dict(count)


def test_empty_table(spark):
    assert cross_alignment(spark.createDataFrame([], DDL.format("long")), A, B).collect() == []


def test_query_equals_brute_force(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    want, _ = brute(list(zip(t["doc_id"], t["text"], strict=True)))
    got = QUERIES["op12_pair_bitmap_alignment"][0](spark, SF).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
