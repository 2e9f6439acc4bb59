import math
import random
import re
from collections import Counter

import pytest

from riskspark.llm.quality_rules import (
    MEASURES, RULES, binomial_lower_tail, choose_cutoffs, judge, measure_text, measures, quality_rules,
)

DDL = "doc_id long, text string, lang string, stratum string, row string, cutoffs string"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_measures_match_brute_force():
    rng = random.Random(1)
    alphabet = ["a", "b", "é", " ", "\n", "\t", "#", "<", " ", "\x1c", "\x0b", "B "]
    for _ in range(2000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        assert measure_text(text)[:5] == brute(text), repr(text)


def test_binomial_tail():
    for n, k, p in [(10, 0, 0.3), (50, 3, 0.2), (2000, 1, 0.01), (5000, 20, 0.01)]:
        exact = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
        assert binomial_lower_tail(n, k, p) == pytest.approx(exact, rel=1e-9)
    assert binomial_lower_tail(10, 9, 0.5) == 1.0


def documents(n, seed):
    """Two strata; bad documents carry symbols."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(60)]
        text = " ".join(w + rng.choice("#$%") if bad else w for w in words)
        rows.append((i, text, rng.choice(["en", None]), "s", "r", "c"))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_cutoffs_keep_good_and_catch_bad(spark):
    rows, labels = documents(6000, 2)
    docs = spark.createDataFrame(rows, DDL)
    held = spark.createDataFrame(labels + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    measured = measures(docs)
    cutoffs = choose_cutoffs(measured, held, risk=0.02)
    found = cutoffs.collect()
    assert {r.stratum for r in found if r.rule == "symbols"} == {"en", None}
    for r in found:
        assert r.p_value <= 0.05 / (2 * len(RULES))
    kept = {r.doc_id: r.kept for r in judge(measured, cutoffs).collect()}
    assert len(kept) == 6000
    good = [i for i, q, _ in labels if q == 1]
    assert sum(kept[i] for i in good) >= 0.98 * len(good)
    bad = [i for i, q, _ in labels if q == 0]
    assert sum(kept[i] for i in bad) < 0.05 * len(bad)


def test_held_out_false_rejection_is_limited(spark):
    rows, labels = documents(6000, 3)
    docs = spark.createDataFrame(rows, DDL)
    fit = spark.createDataFrame(labels[:4500], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality_rules(docs, fit, risk=0.03).collect()}
    unseen = [i for i, q, _ in labels[4500:] if q == 1]
    assert sum(not kept[i] for i in unseen) <= 0.03 * len(unseen)


def test_few_labels_give_no_cutoffs(spark):
    rows, labels = documents(40, 4)
    got = quality_rules(spark.createDataFrame(rows, DDL), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert all(r.kept for r in got.collect())


def test_copies_are_one_draw(spark):
    rows, labels = documents(700, 5)
    good = [i for i, q, _ in labels if q == 1]
    texts = dict((r[0], r[1]) for r in rows)
    # 2,000 more good documents of one text: they are no evidence
    one = texts[good[0]]
    copies = [(10_000 + i, one, "en", "s", "r", "c") for i in range(2000)]
    same = [(r[0], r[1], "en", *r[3:]) for r in rows]
    measured = measures(spark.createDataFrame(same + copies, DDL))
    few = [x for x in labels if x[1] == 0 or x[0] in good[:11]] + [(c[0], 1, 0) for c in copies]
    schema = "doc_id long, quality int, toxic int"
    assert choose_cutoffs(measured, spark.createDataFrame(few, schema)).collect() == []
    # with enough texts, copies change no count, whatever other label one of them has
    once = choose_cutoffs(measured, spark.createDataFrame(labels, schema)).collect()
    again = choose_cutoffs(measured, spark.createDataFrame(labels + [(c[0], 1, 0) for c in copies], schema)).collect()
    assert once and sorted(once) == sorted(again) and all(r.n_good <= len(good) for r in once)
    mixed = choose_cutoffs(measured, spark.createDataFrame([*labels, (10_007, 0, 0)], schema)).collect()
    assert all(r.n_good <= len(good) - 1 for r in mixed)


def test_default_risk_needs_some_hundred_labels(spark):
    """480 good labels a stratum, as sf0.1 has for its smaller languages, and the shipped 1 %."""
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(4 * 530):
        bad = i % 530 >= 480
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(60)]
        rows.append((i, " ".join(w + "#" if bad else w for w in words), ["en", "de", "fr", None][i // 530], "s", "r", "c"))
        labels.append((i, 0 if bad else 1, 0))
    docs, held = spark.createDataFrame(rows, DDL), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = choose_cutoffs(measures(docs), held).collect()
    assert {r.stratum for r in found} == {"en", "de", "fr", None}
    assert all(r.p_value <= 0.05 / 4 and r.n_good >= 437 for r in found)
    kept = {r.doc_id: r.kept for r in quality_rules(docs, held).collect()}
    assert not any(kept[i] for i, q, _ in labels if q == 0)
    assert sum(not kept[i] for i, q, _ in labels if q == 1) <= 0.01 * 4 * 480


def test_the_limit_holds_for_all_rules_together(spark):
    """Two rules that lose 0.8 % of the good documents each may not both pass at 1 %."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(6000):
        bad, odd = i % 10 == 0, i % 125
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(60)]
        hashes = (bad and i % 20 == 0) or odd == 1
        shouts = (bad and i % 20 != 0) or odd == 3
        text = " ".join((w.upper() if shouts else w) + ("#" if hashes else "") for w in words)
        rows.append((i, text, "en", "s", "r", "c"))
        labels.append((i, 0 if bad else 1, 0))
    docs, held = spark.createDataFrame(rows, DDL), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality_rules(docs, held).collect()}
    good = [i for i, q, _ in labels if q == 1]
    assert sum(not kept[i] for i in good) <= 0.01 * len(good)


def test_odd_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    same = " ".join(["a b c"] * 30)
    rows = [(1, None, "en", *"src"), (2, "", None, *"src"), (None, same, "en", *"src"), (None, same, "en", *"src")]
    got = quality_rules(spark.createDataFrame(rows, DDL), labels)
    assert set(MEASURES) | {"doc_id", "base_failed", "kept"} <= set(got.columns)
    assert sorted((str(r.doc_id), r.n_words, r.base_failed, r.kept) for r in got.collect()) == [
        ("1", 0, True, False), ("2", 0, True, False), ("None", 90, True, False), ("None", 90, True, False)]
    assert quality_rules(spark.createDataFrame([], DDL), labels).count() == 0
