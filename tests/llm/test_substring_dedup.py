import hashlib
import random

import pytest

from riskspark.llm import substring_dedup
from riskspark.llm.substring_dedup import anchors, covered_ranges, remove_repeats, shared_parts
from riskspark.llm.suffix_groups import neighbour_prefixes, suffix_array

DDL = "doc_id long, text string, row long, h string"


def brute(rows, length=200):
    places = {}
    raws = [(i, (t or "").encode()) for i, t in rows]
    for k, (_, raw) in enumerate(raws):
        for s in range(len(raw) - length + 1):
            places.setdefault(raw[s : s + length], []).append((k, s))
    out = []
    for k, (i, raw) in enumerate(raws):
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if len(places[raw[s : s + length]]) > 1:
                gone[s : s + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choices("abcdeé fgh ", k=n))
    shared = [prose(rng.randint(190, 700)) for _ in range(6)]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(shared)
            a = rng.randint(0, len(part) // 2)
            part = part[a : rng.randint(a, len(part))] if rng.random() < 0.5 else part
            if rng.random() < 0.4 and part:
                at = rng.randrange(len(part))
                part = part[:at] + rng.choice(["", "X", "YZ"]) + part[at + 1 :]
            text += prose(rng.randint(0, 90)) + part
        rows.append((i, text))
    rows += [(100, None), (101, ""), (102, "x" * 199), (103, "y" * 201), (104, "z" * 200), (105, "ab" * 300),
             (106, rows[0][1]), (106, rows[0][1]), (None, shared[0]), (107, shared[1][:199]), (108, shared[1][:200])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [6_000, 3])
def test_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_CONTEXTS", hot)
    rows = corpus(hot)
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], DDL)
    got = remove_repeats(df).drop("kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], DDL)).count() == 0


def test_anchor_pieces_agree(monkeypatch):
    raw = bytes(random.Random(2).choices(b"abcd", k=5000))
    whole = anchors(raw)
    monkeypatch.setattr(substring_dedup, "PIECE", 700)
    parts = anchors(raw)
    def per_start(found):
        return {s: (h, at) for h, at, first, last in zip(*map(list, found)) for s in range(first, last + 1)}
    assert per_start(whole) == per_start(parts) and len(per_start(whole)) == 4801


@pytest.mark.parametrize("kinds", [1, 2, 4, 30])
def test_suffix_order(kinds):
    rng = random.Random(kinds)
    for _ in range(300):
        s = [rng.randint(-1, kinds) for _ in range(rng.randint(0, 40))]
        order = suffix_array(s)
        assert order == sorted(range(len(s)), key=lambda i: s[i:])
        best = neighbour_prefixes(s, order)
        for i in range(len(s)):
            def common(j):
                k = 0
                while max(i, j) + k < len(s) and s[i + k] == s[j + k]:
                    k += 1
                return k
            assert best[i] == max((common(j) for j in range(len(s)) if j != i), default=0)


def test_ranges_and_parts():
    assert covered_ranges([b"abcdef", b"xbcdey", b"q"], 3) == [[(1, 5)], [(1, 5)], []]
    assert shared_parts([(b"abcdef", 2), (b"xbcdey", 2), (b"zzcqqq", 2)], 4) == [(1, 5), (1, 5), (2, 2)]
