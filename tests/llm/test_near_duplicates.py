import itertools
import random

import numpy as np
import pytest

from riskspark.llm.components import components
from riskspark.llm.minhash import Shingler, band_keys, near_duplicates, sketch

DDL = "doc_id long, text string, lang string, row string, node string"


def shingle_set(text, k):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(rows, k):
    """component and kept by comparing all pairs."""
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        component = min(ids, default=None) if len(sets[i]) else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=str)


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 5)))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(3, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 8)):
            near = list(base)
            for _ in range(rng.randint(0, 6)):
                near[rng.randrange(len(near))] = word()
            texts.append(" ".join(near).upper() if rng.random() < 0.3 else " ".join(near))
    # a chain whose neighbours link and whose ends do not
    chain = [word() for _ in range(200)]
    for _ in range(6):
        texts.append(" ".join(chain))
        chain[: 0] = [word() for _ in range(10)]
        del chain[-10:]
    texts += [None, "", " \n", "one", "ONE", "two words", "É a b c d", "é a b c d"]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("shingle", [4, 5])
def test_matches_all_pairs(spark, shingle):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "en", "x", "y") for i, t in rows], DDL)
    got = near_duplicates(df, shingle=shingle)
    assert got.columns == ["doc_id", "row", "n_shingles", "component_id", "kept", "n_copies"]
    found = sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert found == brute(rows, shingle)


def test_large_group_around_the_threshold(spark):
    """Near copies of one text, edited so that many lie just beyond the similarity of the rest."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(160):
        near = list(base)
        shared = rng.choice([[], [5, 25], [5, 25, 45, 65], list(range(3, 60, 9))])
        for at in shared + rng.sample(range(150), rng.randint(0, 9)):
            near[at] = f"s{at}" if at in shared else f"n{i}-{at}"
        texts.append(" ".join(near))
    rows = list(enumerate(texts))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4)
    found = sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert found == brute(rows, 4)
    assert 3 < len({r[2] for r in found}) < 150


def test_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h i j"
    df = spark.createDataFrame([(None, text, *"xyz"), (7, text, *"xyz"), (7, text, *"xyz"), (None, None, *"xyz"),
                                (9, text + " k", *"xyz"), (None, "q r s t u v w", *"xyz")], DDL)
    got = sorted((tuple(r) for r in near_duplicates(df).select("doc_id", "component_id", "kept").collect()), key=str)
    assert got == sorted([(None, 7, False), (7, 7, True), (7, 7, True), (None, None, True), (9, 7, False),
                          (None, None, True)], key=str)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], DDL)).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (2001, 2000), (2000, 2001)]
    rng.shuffle(edges)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 300)} | {2001: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 30, 700])
def test_sketch_fills_and_estimates(n):
    rng = np.random.default_rng(n)
    a = rng.integers(0, 2**63, n, dtype=np.uint64)
    b = np.concatenate([a[: n - n // 5], rng.integers(0, 2**63, n // 5, dtype=np.uint64)])
    x, y = sketch(a, 512), sketch(b, 512)
    assert x.max() < np.iinfo(np.uint64).max
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((x == y).mean() - truth) < 0.12
    assert (band_keys(a) == band_keys(a[::-1].copy())).all()


def test_shingles():
    s = Shingler(4)
    assert len(s("a b c d a b c d")) == 4 and len(s("a b")) == 1 and len(s(" ")) == 0
    assert (s("A b\tC d") == s("a  B c\nD")).all() and (s("É b") != s("é b")).all()
