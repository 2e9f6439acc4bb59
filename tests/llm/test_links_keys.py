import random
import sys

import numpy as np
import pytest

from riskspark.llm import line_dedup, links
from riskspark.llm.components import components
from riskspark.llm.line_dedup import dedup_lines, normal_line, set_sizes, shingle_hashes, text_lines

steps = sys.modules["riskspark.llm.components"]


def written(monkeypatch, *modules):
    """(name, rows) of the tables that the modules write from now on."""
    tables = []
    for module in modules:
        real = module.materialize

        def noting(df, name, real=real):
            done = real(df, name)
            tables.append((name, done.count()))
            return done

        monkeypatch.setattr(module, "materialize", noting)
    return tables


def test_keys_of_the_same_nodes_are_looked_at_once(spark, monkeypatch):
    whole = set(range(100))
    sets = {n: whole - {n} for n in range(1, 6)} | {6: set(range(500, 600)), 7: set(range(500, 599))}
    data = {n: np.unique(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n, s in sets.items()}
    table = spark.createDataFrame([(n, bytearray(d.tobytes()), len(d)) for n, d in data.items()], "node long, data binary, size long")
    members = [(k, n) for k in range(30) for n in (1, 2, 3, 4, 5)] + [(k, n) for k in range(30, 50) for n in (6, 7)]
    tables = written(monkeypatch, links)
    labels, _ = links.link(spark.createDataFrame(members, "key long, node long"), table, lambda data: np.frombuffer(data, np.uint64), 80)
    assert {r.node: r.root for r in labels.collect()} == {2: 1, 3: 1, 4: 1, 5: 1, 7: 6}
    assert dict(tables)["link-members"] == 7


@pytest.mark.parametrize("most", [-1, 250_000])
def test_components_by_one_task_and_by_rounds(spark, monkeypatch, most):
    monkeypatch.setattr(steps, "TASK_EDGES", most, raising=False)
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, n) for n in range(101, 130)] + [(5, 5), (130, 101), (130, 101)]
    edges += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(45)] + [(-3, 300), (300, -9)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    tables = written(monkeypatch, steps)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got == {n: r for n, r in root.items() if n != r}
    if most > 0:
        assert len(tables) == 1  # no rounds


def test_texts_left_are_made_where_the_texts_lie(spark, monkeypatch):
    tables = written(monkeypatch, line_dedup, links, steps)
    rows = [(1, "one line of text\nanother"), (2, "one line of texts\n\nof its own"), (3, "Another\n")]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "MapInArrow" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got.collect()) == [
        (1, 2, 0, rows[0][1]), (2, 2, 1, "\nof its own"), (3, 1, 1, "")]
    assert len(tables) < 30


def test_lines_with_odd_signs_count_and_go_as_before(spark):
    rng, rows = random.Random(1), []
    for i in range(400):
        signs = rng.choices("ab\n \t\x0b\ré \x85天\x00\x1fZİ", weights=[2, 1, 5] + 12 * [1], k=rng.randint(0, 15))
        text = "".join(signs)
        assert text_lines(text) == [(k, n) for k, line in enumerate(text.split("\n")) if (n := normal_line(line))]
        n = text.count("\n") + 1
        rows.append((i, text, text, sorted(rng.sample(range(n), rng.randint(0, n))) or None))
    df = spark.createDataFrame(rows, "i int, whole string, text string, drop array<int>")
    for r, (_, _, _, drop) in zip(sorted(line_dedup._without(df).collect()), rows, strict=True):
        lines = r.whole.split("\n")
        assert r.n_lines == sum(1 for line in lines if line.strip(" \t\n\v\f\r")) and r.n_removed == len(drop or ())
        assert r.text == "\n".join(line for k, line in enumerate(lines) if k not in (drop or ()))


def test_sizes_of_many_lines_at_once():
    lines = [b"", b"abc", b"aaaaaaaaaa", "天地玄黃宇宙洪荒".encode(), b"plain line of words " * 9, "näive".encode()]
    assert set_sizes(lines).tolist() == [len(shingle_hashes(x)) for x in lines]
    assert set_sizes([]).tolist() == []
