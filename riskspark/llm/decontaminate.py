"""Benchmark passages in training text, found by a hash set of word n-grams. DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.llm.common import free_name, id_and_text, materialize

# Fixed value: a word is a run of ASCII letters (before folding), ASCII digits and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
WINDOW = 13
BROADCAST_ROWS = 1_000_000  # hashes of benchmark windows sent to every executor; joined by shuffle beyond
LEADS = 20_000              # first word pairs that fit a literal set; beyond, every window is hashed


def folded_words(text: Column) -> Column:
    """The words with A-Z lower-cased. ``lower`` folds more than that, so it gets ASCII words only."""
    def fold(w: Column) -> Column:
        return F.when(F.octet_length(w) == F.char_length(w), F.lower(w)).otherwise(
            F.translate(w, string.ascii_uppercase, string.ascii_lowercase))
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), fold)


def lead_hash(hashes: Column, i: Column, n: int) -> Column:
    """Hash of the first two words (or the only one) of the window at ``i``."""
    return F.xxhash64(F.slice(hashes, i, min(2, n)))


def window_hashes(words: Column, leads: dict[int, list[int] | None]) -> Column:
    """struct(pos, len, h) for every window of each length that starts with one of its leads
    (None: every window), behind one marker with pos 0. Words are hashed once.

    The one-element array binds the word hashes to a lambda variable: a plain column could be
    inlined by the optimizer and be computed again for each window.
    """
    def of_length(hashes: Column, n: int) -> Column:
        starts = F.when(F.size(hashes) >= n, F.sequence(F.lit(1), F.size(hashes) - n + 1)).otherwise(
            F.array().cast("array<int>"))
        if leads[n] is not None:
            starts = F.filter(starts, lambda i: lead_hash(hashes, i, n).isin(leads[n]))
        return F.transform(starts, lambda i: F.struct(
            i.alias("pos"), F.lit(n).alias("len"), F.xxhash64(F.slice(hashes, i, n)).alias("h")))

    bound = F.array(F.transform(words, lambda w: F.xxhash64(w)))
    none = F.array(F.struct(F.lit(0).alias("pos"), F.lit(0).alias("len"), F.lit(None).cast("long").alias("h")))
    return F.flatten(F.transform(bound, lambda hs: F.concat(none, *[of_length(hs, n) for n in leads])))


def benchmark_windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """gram, len, h, lead, items: each distinct window of the benchmark with the items that hold it."""
    words = id_and_text(benchmark, id_col, text_col).select(
        F.col("doc_id").cast("string").alias("item_id"), folded_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    rows = words.select("item_id", "w", n.alias("len"), F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("i"))
    part = F.slice("w", F.col("i"), F.col("len"))
    hashed = F.transform(part, lambda w: F.xxhash64(w))
    return (rows.select("item_id", "len", F.array_join(part, " ").alias("gram"), F.xxhash64(hashed).alias("h"),
                        F.xxhash64(F.slice(hashed, 1, 2)).alias("lead"))
            .groupBy("gram", "len", "h", "lead").agg(F.collect_set("item_id").alias("items")))


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(documents, hits): documents has doc_id, row, n_words per input row; hits has doc_id, row,
    pos, len, items per verified occurrence of a benchmark window (``row`` hashes id and text).

    One pass over the text: windows that start with two words some benchmark window starts with
    are hashed and stream past the broadcast hash set; only windows whose hash is in it (with one
    marker row per document) are written. Their words are then compared, so a hash collision is
    no hit.
    """
    grams = materialize(benchmark_windows(benchmark, window, item_col, item_text), "benchmark-windows")
    leads: dict[int, list[int] | None] = {r[0]: None for r in grams.select("len").distinct().collect()}  # at most `window` keys
    pairs = grams.select("len", "lead").distinct().limit(LEADS + 1).collect()
    if len(pairs) <= LEADS:
        leads = {n: [r.lead for r in pairs if r.len == n] for n in leads}
    hashes = grams.select("h", F.lit(True).alias("in_set")).distinct()
    hashes = F.broadcast(hashes) if grams.count() <= BROADCAST_ROWS else hashes.hint("merge")
    worded = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("doc_id", "text").alias("row"), folded_words(F.col("text")).alias("w"))
    windows = worded.select("doc_id", "row", "w", F.inline(window_hashes(F.col("w"), leads)))
    found = materialize(
        windows.join(hashes, "h", "left").where("in_set OR pos = 0")
        .select("doc_id", "row", F.size("w").alias("n_words"), "pos", "len",
                F.when(F.col("pos") > 0, F.array_join(F.slice("w", F.greatest("pos", F.lit(1)), F.col("len")), " ")).alias("gram")),
        "benchmark-candidates")
    hits = found.where("pos > 0").join(grams.select("gram", "items"), "gram").select("doc_id", "row", "pos", "len", "items")
    return found.where("pos = 0").select("doc_id", "row", "n_words"), hits


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, **names: str) -> DataFrame:
    """Per document: doc_id, row, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if any occurrence of a window covers it; a document is contaminated if at
    least one in ``share`` of its words is hit. Null and empty texts have no words and are
    clean; items without words have no windows; an item id of null counts its windows but is no
    item. Repeated rows are reported each, repeated items count once; an empty benchmark leaves
    all clean; empty documents give no rows; extra columns are ignored.
    """
    documents, hits = benchmark_hits(docs, benchmark, window, **names)
    before = Window.partitionBy("row", "doc_id").orderBy("pos", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("pos") + F.col("len")
    covered = F.greatest(F.lit(0), end - F.greatest(F.col("pos"), F.coalesce(F.max(end).over(before), F.lit(0))))
    per = (hits.withColumn("covered", covered).groupBy("row", "doc_id")
           .agg(F.sum("covered").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    per = per.select(F.col("row").alias("r"), F.col("doc_id").alias("d"), "n_hit", "items")
    joined = documents.join(per, (F.col("row") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "row", F.col("n_words").cast("long").alias("n_words"), hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its contaminated rows, all columns kept."""
    name = free_name(docs, "__row")
    bad = (contamination(docs, benchmark, window, share, id_col=id_col, text_col=text_col).where("contaminated")
           .select(F.col("row").alias(name)).distinct())
    key = F.xxhash64(F.col(f"`{id_col}`").cast(docs.schema[id_col].dataType), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return docs.withColumn(name, key).join(bad, name, "left_anti").drop(name)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``docs`` with every hit word, and what stands between it and the word before, cut from the text."""
    _, hits = benchmark_hits(docs, benchmark, window, id_col, text_col)
    row, gone = free_name(docs, "__row"), free_name(docs, "__cut")
    cut = (hits.groupBy(F.col("row").alias(row))
           .agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("pos", F.col("pos") + F.col("len") - 1)))).alias(gone)))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    joined = docs.withColumn(row, F.xxhash64(F.col(f"`{id_col}`"), text)).join(cut, row, "left")
    pieces = F.regexp_extract_all(text, F.lit(OTHER + WORD), F.lit(0))
    kept = F.transform(F.array(pieces), lambda p: F.transform(
        F.array_except(F.sequence(F.lit(1), F.size(p)), F.col(gone)), lambda i: F.element_at(p, i)))[0]
    rest = F.concat(F.array_join(kept, ""), F.regexp_extract(text, f"(?s){OTHER}$", 0))
    return (joined.withColumn(text_col, F.when(F.col(gone).isNull(), F.col(f"`{text_col}`")).otherwise(rest))
            .drop(row, gone))
