"""Quality rules whose cutoffs carry a bound on falsely rejected documents per stratum."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskspark.llm.common import id_kind, materialize

# Code points of the two character sets of the base measures (fixed values).
SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
SYMBOLS = [ord(c) for c in "#*$%&|<>"]

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
MEASURE_SCHEMA = "doc_id {id}, row long, same_text long, stratum string, " + ", ".join(f"{m} long" for m in MEASURES)

#: Rule -> its score; a document whose score is above the rule's cutoff is rejected. All scores
#: are shares or bounded means, so one fixed grid of cutoffs serves any corpus.
RULES = {
    "symbols": "try_divide(n_symbols, n_words)",
    "capitals": "try_divide(n_upper, word_chars)",
    "marks": "try_divide(n_marks, word_chars)",
    "repeated_words": "try_divide(n_repeat_words, n_words)",
    "repeated_lines": "try_divide(n_dup_lines, n_lines)",
    "long_words": "1 - 1 / greatest(try_divide(word_chars, n_words) / 8, 1)",
    "short_words": "1 - least(try_divide(word_chars, n_words) / 8, 1)",
}
GRID = 200  # cutoffs are k / GRID
BUCKETS = 1000  # of texts, by which labels are dealt to design and test


def measure_text(text: str) -> tuple[int, ...]:
    """The measures of one whole text, in the order of ``MEASURES``."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(text) - int(count[SPACES].sum())
    symbols = int(count[SYMBOLS].sum())
    upper = int(count[0x41:0x5B].sum())
    marks = int(count[0x21:0x30].sum() + count[0x3A:0x41].sum() + count[0x5B:0x61].sum() + count[0x7B:0x7F].sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    return n, points, symbols, len(lines) - len(set(lines)), repeated_words(ids, len(seen)), len(lines), upper, marks


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words inside a three-word window that occurs twice or more."""
    if len(ids) < 4:
        return 0
    pair = ids[:-1] * kinds + ids[1:]
    if kinds > 2_000_000:  # three such ids would not fit 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * kinds + ids[2:]
    _, which, times = np.unique(window, return_inverse=True, return_counts=True)
    again = times[which] > 1
    hit = np.zeros(len(ids), bool)
    for k in range(3):
        hit[k : k + len(again)] |= again
    return int(hit.sum())


def measures(docs: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, same_text, stratum and the measures of each document's whole text (null text: empty).
    ``row`` hashes id and text, ``same_text`` the text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [measure_text(t) for t in b.column("text").to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)] or [pa.array([], pa.int64())] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row"), b.column("same_text"), b.column("stratum"), *columns],
                names=["doc_id", "row", "same_text", "stratum", *MEASURES])

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("row"),
                         F.xxhash64(text).alias("same_text"), F.col(f"`{stratum}`").cast("string").alias("stratum"), text.alias("text"))
    return source.mapInArrow(run, MEASURE_SCHEMA.format(id=id_kind(docs, id_col)))


def binomial_lower_tail(n: int, k: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed in logarithms; above the mean 1, an upper bound."""
    if k >= n * p:
        return 1.0
    j = np.arange(k + 1)
    steps = np.log((n - j[:-1]) / (j[:-1] + 1)) + math.log(p) - math.log1p(-p)
    logs = n * math.log1p(-p) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def rule_scores() -> F.Column:
    """One struct (rule, score) per rule; a score without a defined value is 0."""
    return F.array(*[
        F.struct(F.lit(name).alias("rule"), F.coalesce(F.expr(score).cast("double"), F.lit(0.0)).alias("score"))
        for name, score in RULES.items()
    ])


def least_good(risk: float, error: float) -> int:
    """Good documents needed for a bound: the least n with (1 - risk) ** n <= error."""
    return math.ceil(math.log(error) / math.log1p(-risk))


def _with_stratum(rows: DataFrame, per: DataFrame) -> DataFrame:
    """``rows`` with the columns of their stratum, null being one; ``per`` is a written table."""
    # one small row per stratum: sent whole while few, joined by shuffle beyond
    per = F.broadcast(per) if per.count() <= 10_000 else per.hint("merge")
    per = per.withColumnRenamed("stratum", "s")
    return rows.join(per, F.col("stratum").eqNullSafe(F.col("s")), "left").drop("s")


def _halved(holdout: DataFrame, risk: float, limit: float) -> DataFrame:
    """The holdout with ``design`` (else the document is tested) and n_bad, n_design, n_test of its
    stratum. Bad documents are in both parts. The hash of the text alone decides, and a quarter of
    the good ones at most, as far as the rest can still pass, goes to the design."""
    run = Window.partitionBy("stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    good = F.sum("good").over(Window.partitionBy("stratum"))
    # at most BUCKETS rows per stratum
    cells = (holdout.groupBy("stratum", "bucket").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
             .withColumn("n_good", good).withColumn("upto", F.sum("good").over(run))
             .withColumn("taken", F.col("upto") <= F.least(F.floor(F.col("n_good") / 4), F.col("n_good") - least_good(risk, limit))))
    per = cells.groupBy("stratum").agg(
        F.coalesce(F.max(F.when(F.col("taken"), F.col("bucket"))), F.lit(-1)).alias("border"), F.sum("bad").alias("n_bad"),
        F.sum(F.when(F.col("taken"), F.col("good")).otherwise(0)).alias("n_design"),
        F.sum(F.when(F.col("taken"), 0).otherwise(F.col("good"))).alias("n_test"))
    return _with_stratum(holdout, materialize(per, "quality-strata")).withColumn(
        "design", F.col("bucket") <= F.col("border")).drop("bucket", "border")


def _path(holdout: DataFrame, loss_weight: float) -> DataFrame | None:
    """stratum and its path: structs (turn, at, rule, cut), ``at`` counting from 0 in ``RULES``.

    Greedy over the design part: each turn takes, among the documents that the rules so far keep, the
    rule and cutoff of the best share of bad documents caught, less ``loss_weight`` times the
    share of good ones lost; a turn without gain ends the path."""
    rows = holdout.where("design OR good = 0")
    key = Window.partitionBy("stratum", "at")
    upto = key.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    path = picks = None
    for turn in range(len(RULES)):
        left = rows
        if path is not None:
            left = _with_stratum(rows, path).where("path IS NOT NULL AND NOT exists(path, p -> bins[p.at] > p.cut)")
        # a cutoff is a whole below the lowest bin it rejects
        table = (
            left.select("stratum", "good", "n_bad", "n_design", F.posexplode("bins").alias("at", "bin"))
            .groupBy("stratum", "at", "bin").agg(
                F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"),
                F.first("n_bad").alias("n_bad"), F.first("n_design").alias("n_design"))
            .withColumn("gain", F.coalesce(F.try_divide(F.sum("bad").over(upto), "n_bad"), F.lit(0.0))
                        - loss_weight * F.coalesce(F.try_divide(F.sum("good").over(upto), "n_design"), F.lit(0.0)))
            .withColumn("cut", F.col("bin") - 1).where("gain > 0 AND cut >= 0")
        )
        if path is not None:
            table = _with_stratum(table, path).where("NOT exists(path, p -> p.at = at)")
        best = Window.partitionBy("stratum").orderBy(F.desc("gain"), F.desc("cut"), "at")
        names = F.array(*[F.lit(r) for r in RULES])
        pick = materialize(
            table.withColumn("place", F.row_number().over(best)).where("place = 1")
            .select("stratum", F.lit(turn).alias("turn"), "at", names[F.col("at")].alias("rule"), "cut"), "quality-pick")
        if pick.isEmpty():
            break
        picks = pick if picks is None else picks.unionByName(pick)
        path = materialize(picks.groupBy("stratum").agg(
            F.array_sort(F.collect_list(F.struct("turn", "at", "rule", "cut"))).alias("path")), "quality-path")
    return path


CUTOFF_SCHEMA = "stratum string, rule string, cutoff double, n_good long, good_lost long, bad_caught long, p_value double"


def choose_cutoffs(
    measured: DataFrame, labels: DataFrame, risk: float = 0.01, error: float = 0.05, min_words: int = 50,
    loss_weight: float = 20.0, label_id: str = "doc_id", label: str = "quality",
) -> DataFrame:
    """stratum, rule, cutoff, n_good, good_lost, bad_caught, p_value; the last four are those of all
    cutoffs of the stratum together.

    Holdout: the distinct texts of documents labelled 1 (good) or 0 (bad) that pass the base rules; of several
    labels of one document, or of one text of a stratum, the lowest holds, null labels count for nothing. Copies of a text
    are one draw, so the counts are of texts and the bound is for the distinct good texts of a stratum, not for
    its rows: a text that is wrongly rejected goes with all its copies. Texts that differ at all, near copies too,
    are draws of their own. Each stratum tests one
    chain of cutoff vectors, each stricter than the last: rule by rule in the order of its
    path, from the mildest cutoff of the grid down to the path's. The path comes from the bad documents and a
    part of the good ones, the test from the other good ones, so the order does not depend on them. A vector
    passes if the exact binomial probability of losing as few good documents to any of its rules as
    seen, were the true share ``risk``, is at most ``error`` / strata (Bonferroni over
    strata); the chain ends at its first failure, which needs no further correction. With
    probability 1 - ``error`` every stratum so loses at most ``risk`` of its good texts. Of
    the passing vectors the one with the best share of bad documents caught, less ``loss_weight`` times the
    share of good ones lost, is taken, the mildest of equals; without gain there is none.
    """
    held = labels.where(F.col(f"`{label}`").isin(0, 1)).groupBy(F.col(f"`{label_id}`").alias("doc_id")).agg(
        F.min(F.col(f"`{label}`")).cast("long").alias("good"))

    @F.pandas_udf("double")
    def tail(n: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([binomial_lower_tail(a, b, risk) for a, b in zip(n.tolist(), k.tolist(), strict=True)], dtype=float)

    # the lowest k with score <= k / GRID: only cutoffs below it reject the document
    bins = F.transform(rule_scores(), lambda r: F.least(F.lit(GRID), F.ceil(r["score"] * GRID)).cast("int"))
    holdout = materialize(
        measured.where(f"n_words >= {min_words} AND 100 * n_repeat_words <= 50 * n_words")
        .join(held, "doc_id")
        .groupBy("stratum", "same_text").agg(F.min("good").alias("good"), F.first(bins).alias("bins"))  # a text has one row of bins
        .select("stratum", "good", "bins", F.pmod(F.xxhash64("same_text"), F.lit(BUCKETS)).alias("bucket")),
        "quality-holdout")
    limit = error / max(1, holdout.select("stratum").distinct().count())
    holdout = _halved(holdout, risk, limit)
    path = _path(holdout, loss_weight)
    if path is None:
        return measured.sparkSession.createDataFrame([], CUTOFF_SCHEMA)
    # the chain spends GRID - cut steps on a rule, after those of the rules before it
    starts = F.transform("path", lambda p: F.struct(
        p["rule"].alias("rule"), p["at"].alias("at"), p["cut"].alias("cut"),
        F.aggregate(F.filter("path", lambda q: q["turn"] < p["turn"]), F.lit(0), lambda n, q: n + GRID - q["cut"]).alias("start")))
    chain = materialize(path.select("stratum", starts.alias("path")), "quality-chain")
    upto = Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    best = Window.partitionBy("stratum").orderBy(F.desc("gain"), "step")
    # one row per step at which some document is first rejected: at most rules x grid per stratum
    table = (
        _with_stratum(holdout.where("good = 0 OR NOT design"), chain)
        .withColumn("step", F.expr(f"array_min(transform(filter(path, p -> bins[p.at] > p.cut), p -> p.start + {GRID} - bins[p.at] + 1))"))
        .where("step IS NOT NULL")
        .groupBy("stratum", "step").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"),
                                        F.first("n_test").alias("n_good"), F.first("n_bad").alias("n_bad"))
        .withColumn("good_lost", F.sum("good").over(upto)).withColumn("bad_caught", F.sum("bad").over(upto))
        .withColumn("p_value", tail("n_good", "good_lost"))
        .withColumn("passes", F.min((F.col("p_value") <= limit).cast("int")).over(upto))
        .withColumn("gain", F.expr(f"try_divide(bad_caught, n_bad) - {loss_weight} * try_divide(good_lost, n_good)"))
        .where("passes = 1 AND gain > 0")
        .withColumn("place", F.row_number().over(best)).where("place = 1")
    )
    return (
        _with_stratum(materialize(table.select("stratum", "step", "n_good", "good_lost", "bad_caught", "p_value"), "quality-steps"), chain)
        .select("*", F.inline("path")).where("step > start")
        .select("stratum", "rule", (F.greatest(F.col("cut"), GRID - F.col("step") + F.col("start")) / GRID).alias("cutoff"),
                "n_good", "good_lost", "bad_caught", "p_value"))


def judge(measured: DataFrame, cutoffs: DataFrame, min_words: int = 50) -> DataFrame:
    """The measures with base_failed, failed_rules and kept."""
    per = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    failed = F.filter(rule_scores(), lambda r: F.coalesce(r["score"] > F.element_at("cutoffs", r["rule"]), F.lit(False)))
    return (
        _with_stratum(measured, materialize(per, "quality-cutoffs"))
        .withColumn("base_failed", F.expr(f"n_words < {min_words} OR 100 * n_repeat_words > 50 * n_words"))
        .withColumn("failed_rules", F.transform(failed, lambda r: r["rule"]))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
        .drop("cutoffs")
    )


def quality_rules(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.01, error: float = 0.05,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every document with its measures, base_failed, failed_rules and kept.

    Null and empty texts have no words and fail the base rules. A null stratum is a stratum of
    its own. Strata without labels, or without enough of them for any cutoff, keep what passes
    the base rules. Repeated rows are judged each; null ids stay null and take no label; empty
    tables give no rows, or no cutoffs; extra columns are ignored.
    """
    measured = materialize(measures(docs, stratum, id_col, text_col), "quality-measures")
    return judge(measured, choose_cutoffs(measured, labels, risk, error))
