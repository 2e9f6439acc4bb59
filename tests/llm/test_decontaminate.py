import hashlib
import random
import re
import string

import pytest

from riskspark.llm import decontaminate
from riskspark.llm.decontaminate import contamination, remove_documents, remove_spans

DOCS = "doc_id long, text string, row long, w string, items string"
ITEMS = "item_id long, text string, gram string"
EMPTY = hashlib.sha256(b"").hexdigest()


def words(text):
    folded = (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def brute(docs, items, window=13):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for i in range(len(w)):
            for n in range(1, window + 1):
                g = grams.get(tuple(w[i : i + n])) if i + n <= len(w) else None
                if g is not None:
                    hit |= set(range(i, i + n))
                    found |= g
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdeéÉ0", k=rng.randint(1, 4))) for _ in range(40)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([2, 3, 5, 13, 14, 30]))) for i in range(15)] + [(3, "x Y z"), (20, None), (21, ""), (22, "?!"),
                                                                             (None, text(13))]
    items += [items[0], (30, items[5][1])]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            parts += [(rng.choice(items)[1] or "").upper() if rng.random() < 0.5 else rng.choice(items)[1] or "", text(rng.randint(0, 80))]
        docs.append((i, rng.choice([" ", "\n", ", "]).join(parts)))
    docs += [(90, None), (91, ""), (92, "..."), (None, items[4][1]), (93, "x y z"), (93, "x y z")]
    return docs, items


@pytest.mark.parametrize(("leads", "rows"), [(20_000, 1_000_000), (1, 1)])
def test_matches_brute_force(spark, monkeypatch, leads, rows):
    monkeypatch.setattr(decontaminate, "LEADS", leads)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
    docs, items = corpus()
    got = contamination(spark.createDataFrame([(i, t, 1, "a", "b") for i, t in docs], DOCS),
                        spark.createDataFrame([(i, t, "g") for i, t in items], ITEMS))
    assert sorted((tuple(r) for r in got.drop("row").collect()), key=str) == brute(docs, items)


def test_plan_has_no_python(spark):
    docs, items = corpus()
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_removal(spark):
    docs = spark.createDataFrame([(1, "keep this one two three, and rest", "en"), (2, "one two three", "en"), (3, None, "fr")],
                                 "doc_id long, text string, lang string")
    items = spark.createDataFrame([(1, "One two THREE")], "item_id long, text string")
    assert {r.doc_id: r.text for r in remove_spans(docs, items).collect()} == {1: "keep this, and rest", 2: "", 3: None}
    assert sorted(r.doc_id for r in remove_documents(docs, items).collect()) == [3]
    assert remove_documents(docs, items, share=1).columns == ["doc_id", "text", "lang"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([], ITEMS)
    assert contamination(none, spark.createDataFrame([(1, "a", "g")], ITEMS)).count() == 0
    row = contamination(spark.createDataFrame([(1, "a b", 1, "a", "b")], DOCS), items).drop("row").first()
    assert tuple(row) == (1, 2, 0, 0, EMPTY, False)
