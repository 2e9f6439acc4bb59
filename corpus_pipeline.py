"""From raw documents to packed training sequences: quality, lines, near copies, benchmarks, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm.common import keep_rows, materialize
from riskspark.llm.decontaminate import remove_documents
from riskspark.llm.line_dedup import dedup_lines
from riskspark.llm.minhash import near_duplicates
from riskspark.llm.packing import pack
from riskspark.llm.quality_rules import quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled rules keep."""
    judged = quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_rows(docs, judged.where("kept")).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of near-equal lines stays; a document that lost all its lines goes."""
    cut = dedup_lines(docs).where("n_removed < n_lines OR n_lines = 0")
    return cut.select("doc_id", "text", "rest.lang", "rest.source", F.length("text").cast("long").alias("n_chars"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five words, similarity 0.8."""
    return keep_rows(docs, near_duplicates(docs, shingle=5).where("kept")).select(COLUMNS)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_copies),
    ("decontamination", benchmarks),
    ("packing", packing),
]

#: SQL can express neither the fuzzy stages' sketches nor the tokenizer; a test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
