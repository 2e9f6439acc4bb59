"""Ids of any type, and columns named like the operators' own helpers."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from riskspark.llm.common import keep_rows, row_key
from riskspark.llm.decontaminate import contamination, remove_documents, remove_spans
from riskspark.llm.line_dedup import dedup_lines
from riskspark.llm.minhash import near_duplicates
from riskspark.llm.packing import pack
from riskspark.llm.personal_data import mask, personal_data
from riskspark.llm.quality_rules import quality_rules
from riskspark.llm.substring_dedup import remove_repeats

WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i}" for i in range(60))
TEXTS = ["mail me at a@b.org", LONG, LONG + " more", None, ""]
EXTRA = "__row string, __cut string, row long, node long, key long"


def table(spark, ids):
    kind = "string" if isinstance(ids[0], str) else "long"
    return spark.createDataFrame(
        [(i, t, "en", "s", 1, f"r{n}", f"c{n}", n, n, n) for n, (i, t) in enumerate(zip(ids, TEXTS, strict=True))],
        f"doc_id {kind}, text string, lang string, source string, n_chars long, {EXTRA}")


OPERATORS = {
    "quality": lambda s, d: quality_rules(d, s.createDataFrame([], f"doc_id {d.schema['doc_id'].dataType.simpleString()}, quality int, toxic int")),
    "pack": lambda s, d: pack(d, WORDS, 16),
    "personal": lambda s, d: personal_data(d),
    "mask": lambda s, d: mask(d),
    "near": lambda s, d: near_duplicates(d, shingle=4),
    "lines": lambda s, d: dedup_lines(d).select("doc_id", "text"),
    "repeats": lambda s, d: remove_repeats(d, 50),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_text_ids_give_what_numbers_give(spark, name):
    numbers = OPERATORS[name](spark, table(spark, [10, 11, 12, 13, 14]))
    texts = OPERATORS[name](spark, table(spark, ["k10", "k11", "k12", "k13", "k14"]))
    assert dict(texts.dtypes)["doc_id"] == "string" and dict(numbers.dtypes)["doc_id"] == "bigint"
    named = [c for c in numbers.columns if c not in ("row", "component_id")]
    want = sorted(str((f"k{r.doc_id}", *[r[c] for c in named if c != "doc_id"])) for r in numbers.collect())
    assert sorted(str((r.doc_id, *[r[c] for c in named if c != "doc_id"])) for r in texts.collect()) == want


def test_columns_named_like_helpers_stay(spark):
    docs = table(spark, ["a", "b", "c", "d", "e"])
    bench = spark.createDataFrame([("i", " ".join(f"word{i}" for i in range(13)))], "item_id string, text string")
    kept = keep_rows(docs, docs.select(row_key().alias("row")).where(F.col("doc_id") != "a"))
    assert kept.columns == docs.columns and sorted(r["__row"] for r in kept.collect()) == ["r1", "r2", "r3", "r4"]
    clean = remove_documents(docs, bench)
    assert clean.columns == docs.columns and sorted(r["__row"] for r in clean.collect()) == ["r0", "r3", "r4"]
    cut = remove_spans(docs, bench)
    assert cut.columns == docs.columns and sorted(r["__cut"] for r in cut.collect()) == [f"c{n}" for n in range(5)]
    assert contamination(docs, bench).where("contaminated").count() == 2
