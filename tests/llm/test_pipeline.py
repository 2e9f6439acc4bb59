"""The pipeline and the registered queries against plain Python over the smallest tables."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from riskspark.llm.line_dedup import SHINGLE, normal_line, text_lines
from riskspark.llm.queries import QUERIES
from test_decontaminate import brute as contaminated_rows
from test_near_duplicates import shingle_set
from test_personal_data import brute as base_spans
from test_quality_rules import brute as base_measures
from test_substring_dedup import brute as repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"], strict=True))


@pytest.fixture(scope="module")
def items():
    t = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    return list(zip(t["item_id"], t["text"], strict=True))


def similar_pairs(sets, percent=80):
    """All pairs at the similarity, through shared elements."""
    holders = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            holders[x].append(k)
    common = Counter()
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                common[a, b] += 1
    return [(a, b) for (a, b), c in common.items() if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)]


def roots(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_quality(docs):
    """Too few labels here for any cutoff, so the base rules decide."""
    out = []
    for i, t in docs:
        m = base_measures(t)
        if m[0] >= 50 and 100 * m[4] <= 50 * m[0]:
            out.append((i, t))
    return out


def plain_lines(docs):
    distinct = {n for _, t in docs for _, n in text_lines(t)}
    sets = {n: {n[i : i + SHINGLE] for i in range(len(n) - SHINGLE + 1)} for n in distinct if len(n) >= SHINGLE}
    root, seen, out = roots(distinct, similar_pairs(sets)), set(), []
    for i, t in sorted(docs):
        kept = []
        for line in t.split("\n"):
            n = normal_line(line)
            if not n or root[n] not in seen:
                kept.append(line)
            if n:
                seen.add(root[n])
        if any(map(normal_line, kept)) or not text_lines(t):
            out.append((i, "\n".join(kept)))
    return out


def plain_near(docs):
    sets = {i: shingle_set(t, 5) for i, t in docs}
    root = roots(sets, similar_pairs(sets))
    return [(i, t) for i, t in docs if root[i] == i]


def test_stages_match_plain_python(spark, documents, items):
    docs, want = spark.read.parquet(f"{SF}/documents.parquet"), documents
    plain = [plain_quality, plain_lines, plain_near,
             lambda rows: [r for r, c in zip(sorted(rows), sorted(contaminated_rows(rows, items)), strict=True) if not c[5]]]
    columns = docs.columns
    assert len(corpus_pipeline.STAGES) == 5
    for (name, stage), step in zip(corpus_pipeline.STAGES, plain):
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        want = step(want)
        assert docs.columns == columns
        assert sorted(tuple(r) for r in docs.select("doc_id", "text").collect()) == sorted(want), name
        assert all(r.n_chars == len(r.text) for r in docs.collect())
    exact = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, SF).orderBy("sequence_id", "offset").collect()
    got = defaultdict(bytes)
    for p in pieces:
        assert p.start * 4 == len(got[p.doc_id])
        got[p.doc_id] += bytes(p.ids)
    assert dict(got) == {i: np.array([*exact.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in want}
    assert [p.sequence_id * 2048 + p.offset for p in pieces] == np.cumsum([0, *[p.length for p in pieces[:-1]]]).tolist()


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0


def test_personal_data_query(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op5_offset_preserving_pii"][0](spark, SF).collect()}
    for i, t in documents:
        base = base_spans(t or "")
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(map(len, base.values()))


def test_quality_query(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op1_risk_controlled_rules"][0](spark, SF).collect()}
    for i, t in documents:
        r, m = got[i], base_measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and not (r.base_failed and r.kept)


def test_substring_query(spark, documents):
    got = QUERIES["op10_lyndon_group_substring_dedup"][0](spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == repeats(documents)


def test_license_query_finds_notices(spark, documents):
    notices = {"All rights reserved.": "all-rights-reserved", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
               "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
               "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    got = {r.doc_id: r.licenses for r in QUERIES["op3_sentence_rule_licenses"][0](spark, SF).collect()}
    for i, t in documents:
        lines = set((t or "").split("\n"))
        assert {x for n, x in notices.items() if n in lines} <= set(got[i].split(","))
        assert all(any(n in (t or "") for n, y in notices.items() if y == x) for x in got[i].split(",") if x)


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_queries_match_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    run, sql = QUERIES[name]
    df, rel = run(spark, SF), con.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(map(str, rel.fetchall()))
    assert sorted(str(tuple(r)) for r in df.select(*names).collect()) == want
