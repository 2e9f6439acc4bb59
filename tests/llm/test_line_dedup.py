import itertools
import random

import numpy as np
import pytest

from riskspark.llm import line_dedup, links
from riskspark.llm.line_dedup import SHINGLE, dedup_lines, line_bands, normal_line, shingle_hashes, text_lines

DDL = "doc_id long, text string, lang string, row long, rest string"


def line_shingles(line):
    return {line[i : i + SHINGLE] for i in range(len(line) - SHINGLE + 1)}


def similar_lines(a, b):
    x, y = line_shingles(a), line_shingles(b)
    assert len(x) == len(shingle_hashes(a)) and len(x & y) == len(np.intersect1d(shingle_hashes(a), shingle_hashes(b)))
    return 100 * len(x & y) >= 80 * len(x | y)


def brute(rows):
    """Text left per row, by comparing all pairs of distinct lines."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    distinct = sorted({n for _, t in rows for _, n in text_lines(t or "")})
    root = {n: n for n in distinct}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(distinct, 2):
        if len(a) >= SHINGLE and len(b) >= SHINGLE and similar_lines(a, b):
            root[find(a)] = find(b)
    seen, out = set(), [None] * len(rows)
    for i in order:
        text = rows[i][1]
        kept, gone, total = [], 0, 0
        for line in (text or "").split("\n"):
            n = normal_line(line)
            total += bool(n)
            if n and find(n) in seen:
                gone += 1
                continue
            if n:
                seen.add(find(n))
            kept.append(line)
        out[i] = (rows[i][0], total, gone, None if text is None else "\n".join(kept))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 8)))
    pool = [" ".join(word() for _ in range(rng.randint(1, 25))) for _ in range(25)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(0, 7)):
            line = rng.choice(pool) if rng.random() < 0.6 else " ".join(word() for _ in range(rng.randint(1, 12)))
            if rng.random() < 0.4 and len(line) > 60:
                at = rng.randrange(len(line))
                line = line[:at] + "Z" + line[at + 1 :]
            lines.append(rng.choice([line, line.upper(), "  " + line.replace(" ", "  "), ""]))
        rows.append((i, "\n".join(lines)))
    rows += [(50, None), (51, ""), (52, "\n\n"), (None, pool[0]), (53, "a"), (54, "A\nb\na"), (54, "A\nb\na")]
    rng.shuffle(rows)
    return rows


def test_matches_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "en", 1, "x") for i, t in rows], DDL).coalesce(1)
    got = dedup_lines(df)
    assert got.columns == ["doc_id", "rest", "n_lines", "n_removed", "text"]
    found = sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_removed", "text").collect()), key=str)
    assert found == brute(rows)
    assert got.select("rest.row").distinct().collect()[0][0] == 1


def test_empty_and_single_column_tables(spark):
    assert dedup_lines(spark.createDataFrame([], DDL)).count() == 0
    got = dedup_lines(spark.createDataFrame([(1, "x y"), (2, "X  y")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, "x y"), (2, "")]


@pytest.mark.parametrize("edits", [1, 2])
def test_bands_find_near_lines(edits):
    rng = np.random.default_rng(edits)
    pairs = []
    for _ in range(300):
        a = bytes(rng.integers(97, 123, 200).astype(np.uint8))
        b = bytearray(a)
        for _ in range(edits):
            b[rng.integers(0, 200)] = 33
        pairs.append((a, bytes(b)))
    met = [bool((k[0] == k[1]).any()) for k in (line_bands([a, b]) for a, b in pairs)]
    near = [similar_lines(a, b) for a, b in pairs]
    assert sum(m for m, n in zip(met, near) if n) >= 0.98 * sum(near) > 0


def test_bands_of_the_shortest_line():
    a, b = b"x" * SHINGLE, b"y" * SHINGLE
    both = line_bands([a, b])
    assert (both[0] == line_bands([a])[0]).all() and (both[1] == line_bands([b])[0]).all()
    assert not (both[0] == both[1]).any()


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщ", "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往"])
def test_one_word_edits_in_short_lines(spark, letters):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices(letters, k=rng.randint(2, 9)))
    planted = []
    for _ in range(60):
        words = [word() for _ in range(9)]
        while not 50 <= len(" ".join(words)) <= 130:
            words = [word() for _ in range(rng.randint(8, 20))]
        edited = list(words)
        at = rng.randrange(1, len(words) - 1)
        edited[at] = edited[at][:-1] + rng.choice(letters)
        planted.append((" ".join(words), " ".join(edited)))

    def near(a, b):
        x, y = ({t[i : i + 5] for i in range(len(t) - 4)} for t in (a, b))
        return 100 * len(x & y) >= 80 * len(x | y)

    want = [near(a, b) for a, b in planted]
    assert sum(want) > 30
    rows = [(2 * i + k, line) for i, pair in enumerate(planted) for k, line in enumerate(pair)]
    got = {r.doc_id: r.n_removed for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [bool(got[2 * i + 1]) for i in range(len(planted))] == want
    assert not any(got[2 * i] for i in range(len(planted)))


def test_hashes_do_not_depend_on_neighbours():
    lines = ["plain ascii line", "näive zeile", "天地玄黃宇宙"]
    both = line_bands([x.encode() for x in lines])
    for k, line in enumerate(lines):
        assert (both[k] == line_bands([line.encode()])[0]).all()
        assert len(shingle_hashes(line.encode())) == len(line) - SHINGLE + 1


def test_bands_miss_few_lines_near_the_limit():
    rng = np.random.default_rng(4)
    lines = []
    while len(lines) < 12_000:
        a = rng.integers(97, 123, 200).astype(np.uint8)
        b = a.copy()
        b[rng.choice(200, 5, replace=False)] = 33
        a, b = a.tobytes(), b.tobytes()
        x, y = line_shingles(a), line_shingles(b)
        if 80 * len(x | y) <= 100 * len(x & y) <= 82 * len(x | y):
            lines += [a, b]
    keys = line_bands(lines)
    assert (~(keys[::2] == keys[1::2]).any(axis=1)).sum() <= 1  # 12 bands of 4 miss 5 of these 6,000


def test_buckets_need_no_window(spark, monkeypatch):
    """A window would send all rows of a band key through one task."""
    plans = []
    for module in (line_dedup, links):
        real = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name, real=real: (
            plans.append(df._jdf.queryExecution().optimizedPlan().toString()), real(df, name))[1])
    dedup_lines(spark.createDataFrame([(1, "one line of text"), (2, "one line of texts")], "doc_id long, text string")).count()
    assert plans and not any("Window" in p for p in plans)
