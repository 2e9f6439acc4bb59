import random
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riskspark.llm.ppm import EDGE, ORDER, SYMBOLS, adaptive_log10, adaptive_scores, byte_grams, counted_grams, ppm_scores
from riskspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DDL = "doc_id {}, text string, block long, at int, place int, grams string, held_out string"
NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


class Trie:
    """Byte contexts one by one."""

    def __init__(self, texts):
        self.counts = defaultdict(Counter)
        for t in texts:
            s = bytes([EDGE]) * ORDER + t + bytes([EDGE])
            for i in range(ORDER, len(s)):
                for k in range(ORDER + 1):
                    self.counts[s[i - k : i]][s[i]] += 1

    def symbol(self, history, symbol):
        excluded, total = set(), 0.0
        for k in range(ORDER, -1, -1):
            left = {s: n for s, n in self.counts.get(history[ORDER - k :], {}).items() if s not in excluded}
            if not left:
                continue
            both = sum(left.values()) + len(left)
            if symbol in left:
                return total + log10(left[symbol] / both)
            total += log10(len(left) / both)
            excluded |= set(left)
        return total - log10(SYMBOLS - len(excluded))

    def score(self, text):
        s = bytes([EDGE]) * ORDER + text + bytes([EDGE])
        return sum(self.symbol(s[i - ORDER : i], s[i]) for i in range(ORDER, len(s)))


def brute(rows):
    """Rows in order; a document is held out by the checksum of its id."""
    docs = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1, (t or "").encode().lower()) for i, t in rows]
    train = [t for _, out, t in docs if not out]
    trie, tokens = Trie(train), Counter(w for t in train for w in [*t.split(), None])
    n, v = sum(tokens.values()), len(tokens)
    out = []
    for i, held, t in docs:
        words = [*t.split(), None]
        base = sum(log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((i, held, len(words), sum(tokens[w] > 0 for w in words), n, base, trie.score(t)))
    return out


def same(got, want):
    key = lambda r: tuple(map(str, r[:5])) + (round(r[5], 3), round(r[6], 3))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-6, atol=1e-6)


def held_out(column="doc_id"):
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % 5 == 1


@pytest.mark.parametrize("kind", ["long", "string"])
def test_equals_a_trie(spark, kind):
    rng = random.Random(11)
    words = ["the", "The", "then", "été", "语", "a\x00b", "zq", "\x7f", "😀", "x" * 50]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 40]))) for _ in range(70)] + [None, "", "\n\t", "y" * 3000]
    ids = [i if kind == "long" else f"k{i}" for i in range(len(texts))]
    ids[4] = None
    rows = list(zip(ids, texts, strict=True)) + [(ids[7], texts[7])]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, "x", "y") for i, t in rows], DDL.format(kind)).repartition(3)
    same(ppm_scores(docs, held_out()).select(NAMES).collect(), brute(rows))


def test_no_training_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "ab", 1, 2, 3, "x", "y"), (2, None, 1, 2, 3, "x", "y")], DDL.format("long"))
    got = {r.doc_id: r for r in ppm_scores(docs, F.lit(True)).collect()}
    assert got[1].score == pytest.approx(-3 * log10(256)) and got[2].score == pytest.approx(-log10(256))
    assert [(r.n_known, r.train_tokens, r.base_score) for r in got.values()] == [(0, 0, 0.0)] * 2
    assert ppm_scores(docs.limit(0), held_out()).collect() == []


def test_query_equals_a_trie(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    rows = list(zip(t["doc_id"], t["text"], strict=True))
    got = QUERIES["op11_ppm_scores"][0](spark, SF).select(NAMES).collect()
    same(got, brute(rows))
    # held-out text costs fewer bits than under its own bytes' frequencies
    size = {i: len((x or "").encode()) for i, x in rows}
    raw = b"".join((x or "").encode().lower() for _, x in rows)
    order0 = -sum(n * log10(n / len(raw)) for n in Counter(raw).values()) / len(raw)
    out = [r for r in got if r.held_out]
    assert len(out) > 10 and -sum(r.score for r in out) / sum(size[r.doc_id] for r in out) < 0.75 * order0


def test_probabilities_add_up_to_one():
    trie = Trie([b"abracadabra", b"abba", b""])
    for history in (b"\xff" * 5, b"\xff\xff\xffab", b"zzzzz", b"adabr", b"racad"):
        total = sum(10 ** trie.symbol(history, s) for s in range(256))
        assert total == pytest.approx(1)


def test_grams_stay_in_their_text():
    texts = [b"", b"ab", b"abcdefgh", b""]
    gram, doc = byte_grams(texts)
    want = []
    for d, t in enumerate(texts):
        s = bytes([EDGE]) * ORDER + t + bytes([EDGE])
        want += [(int.from_bytes(s[i - ORDER : i + 1], "big"), d) for i in range(ORDER, len(s))]
    assert list(zip(gram.tolist(), doc.tolist(), strict=True)) == want
    g, d, n = counted_grams([b"aaaaaaaaa", b"aaaaaaa"])
    assert Counter({(a, b): c for a, b, c in zip(g.tolist(), d.tolist(), n.tolist(), strict=True)}) == Counter(
        zip(*(x.tolist() for x in byte_grams([b"aaaaaaaaa", b"aaaaaaa"])), strict=True))


def test_adaptive_scores_learn_from_the_text_itself(spark):
    assert adaptive_log10(b"") == pytest.approx(-log10(256))
    random_bytes = random.Random(1).randbytes(300)
    assert adaptive_log10(b"abc" * 100) > 0.2 * adaptive_log10(random_bytes)
    rows = [(1, "Some text, some Text"), (None, None), (2, "")]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, "x", "y") for i, t in rows], DDL.format("long"))
    got = {(r.doc_id, r.n_bytes): r.score for r in adaptive_scores(docs).collect()}
    assert got == {(i, len((t or "").encode())): adaptive_log10((t or "").encode().lower()) for i, t in rows}
    # one symbol after another: what is left of 1 each time is shared among unseen symbols
    assert adaptive_log10(b"a", order=0) == pytest.approx(-log10(256) + log10(1 / 2) - log10(255))
