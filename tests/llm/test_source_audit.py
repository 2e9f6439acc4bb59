import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm.source_audit import TOP_TERMS, _few, _summed, share, source_audit

DDL = "doc_id long, text string, lang string, source string, code long, place int, term string, word string"


def brute(rows):
    docs = [(t or "", la or "", s or "") for t, la, s in rows]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t, _, _ in docs]
    held = defaultdict(Counter)
    for (_, lang, _), found in zip(docs, terms, strict=True):
        held[lang].update(set(found))
    out = []
    for lang in {la for _, la, _ in docs}:
        kept = [t for t, n in held[lang].items() if n >= 3]
        sources = sorted({s for _, la, s in docs if la == lang})

        def shares(chosen):
            n = Counter(t for d, f in zip(docs, terms, strict=True) if d[1] == lang and d[2] in chosen for t in f)
            total = sum(n[t] for t in kept)
            return n, {t: 1 + 10**9 * (n[t] + 1) // (total + len(kept)) for t in kept}

        _, q = shares(sources)
        of = {s: shares([s]) for s in sources}
        for s in sources:
            n, p = of[s]
            pair = [(o, sum((p[t] - of[o][1][t]) ** 2 // of[o][1][t] for t in kept)) for o in sources if o != s]
            term = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if n[t] and p[t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(found, 1) if part == "pair" or r <= TOP_TERMS]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, 1, 2, "x", "y") for i, r in enumerate(rows)], DDL)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    words = ["the", "The", "don't", "co-op", "co", "op", "été", "Été", "ÉTÉ", "語彙", "a\x00b", "x1y", "42", "--", " nbsp ", "　", "end.", "(end"]
    words += [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for _ in range(120):
        text = "".join(rng.choice(words) + rng.choice(" \t\n\r\x0b\x0c") for _ in range(rng.choice([0, 1, 5, 60])))
        rows.append((rng.choice([text, text, text, None]), rng.choice(["en", "en", "en", "fr", None, ""]), rng.choice(["a", "a", "a", "b", "c", None])))
    rows += [("rare words only here", "de", "a"), (None, "de", "b"), ("", "xx", "only")]
    rows += [("long " * 40_000 + "word", "en", "c")] * 2 + rows[:10]
    return rows


def test_equals_brute_force(spark, corpus):
    got = sorted(tuple(r) for r in source_audit(frame(spark, corpus)).collect())
    assert got == brute(corpus)


def test_empty_table(spark):
    assert source_audit(frame(spark, [])).collect() == []


def test_texts_without_terms(spark):
    rows = [("1 2 3", "en", "a"), ("--", "en", "b"), (None, None, None)]
    assert sorted(tuple(r) for r in source_audit(frame(spark, rows)).collect()) == brute(rows)


def test_shares_are_exact_for_large_counts(spark):
    cases = [(1, 3), (5 * 10**11, 9 * 10**12 + 7), (7 * 10**15, 9 * 10**15), (1, 9 * 10**15), (3, 3), (1, 0)]
    got = spark.createDataFrame(cases, "n long, total long").select("n", "total", share(F.col("n"), F.col("total"))).collect()
    for n, total, p in got:
        assert p == (1 + int(Fraction(10**9 * n, total)) if total else None)


def test_short_lists_tell_exactly_whether_three_documents_hold_a_word():
    rng = np.random.default_rng(3)
    word, lang, doc = (rng.integers(0, k, 4000) for k in (200, 3, 40))
    parts = [_few(word[i::7], lang[i::7], doc[i::7]) for i in range(7)]
    merged = Counter(zip(*(x.tolist() for x in _few(*map(np.concatenate, zip(*parts, strict=True)))[:2]), strict=True))
    exact = Counter((w, la) for w, la, _ in set(zip(word.tolist(), lang.tolist(), doc.tolist(), strict=True)))
    assert {k: min(n, 3) for k, n in exact.items()} == merged


def test_counts_add_up_per_word_and_code():
    rng = np.random.default_rng(5)
    word, code = rng.integers(0, 30, 2000), rng.integers(0, 2**63, 5, dtype=np.uint64)[rng.integers(0, 5, 2000)]
    n = rng.integers(1, 2**40, 2000)
    want = Counter()
    for w, c, k in zip(word.tolist(), code.tolist(), n.tolist(), strict=True):
        want[w, c] += k
    assert {(w, c): k for w, c, k in zip(*(x.tolist() for x in _summed(word, code, n)), strict=True)} == want
