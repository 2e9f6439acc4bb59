"""Token counts through a cache keyed by content digest and tokenizer digest."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm.common import id_and_text, materialize
from riskspark.llm.tokens import byte_level_counter, version_digest

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"


def read_cache(spark: SparkSession, cache_path: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer version; empty where the cache does not exist yet."""
    try:
        cache = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        cache = spark.createDataFrame([], CACHE_SCHEMA)
    # two runs may have appended the same digest
    return (cache.where(F.col("tokenizer") == tokenizer).groupBy("digest")
            .agg(F.max("n_tokens").alias("n_tokens")))


def token_counts(
    docs: DataFrame, cache_path: str, tokenizer_path: str, max_tokens: int = 1024,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit, cached.

    Content is normalised only as far as the count allows: null becomes the empty text, every
    other text stands as it is. Digests (SHA-256, with the SHA-256 of the tokenizer file) are
    joined to the cache at ``cache_path``; of the texts it lacks, one row per digest is encoded
    and appended. The join key of that step holds a row hash beside the digest, so that copies
    spread over all tasks and only the chosen one reaches Python.

    Empty texts have 0 tokens; repeated rows are counted each; null ids stay null; an empty
    table gives no rows. Extra columns are ignored. ``cached`` tells whether the count was
    stored before this call.
    """
    spark = docs.sparkSession
    tokenizer = version_digest(tokenizer_path)
    source = id_and_text(docs, id_col, text_col)
    digest = F.unhex(F.sha2("text", 256))
    keyed = materialize(
        source.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                      digest.alias("digest")).withColumn("row", F.xxhash64("doc_id", "digest")),
        "token-keys")
    stored = materialize(read_cache(spark, cache_path, tokenizer), "token-stored")
    chosen = (keyed.groupBy("digest").agg(F.min("row").alias("row"))
              .join(stored, "digest", "left_anti"))
    texts = source.select(digest.alias("digest"), "doc_id", "text").select(
        "digest", F.xxhash64("doc_id", "digest").alias("row"), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, last = byte_level_counter(tokenizer_path), None
        for b in batches:
            digests, n = [], []
            for d, text in zip(b.column("digest").to_pylist(), b.column("text").to_pylist(), strict=True):
                if d != last:  # rows that repeat id and text follow one another in the sorted join
                    digests.append(d)
                    n.append(count(text))
                last = d
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(n, pa.int64())], names=["digest", "n_tokens"])

    # a broadcast of the chosen rows would grow with the corpus
    fresh = (texts.join(chosen.hint("merge"), ["digest", "row"], "left_semi").select("digest", "text")
             .mapInArrow(encode, "digest binary, n_tokens long"))
    (fresh.withColumn("tokenizer", F.lit(tokenizer))
     .write.mode("append").partitionBy("tokenizer").parquet(cache_path))
    counts = read_cache(spark, cache_path, tokenizer)
    old = stored.select("digest", F.lit(True).alias("cached"))
    counts = materialize(counts.join(old, "digest", "left"), "token-counts")
    return keyed.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit"),
        F.coalesce("cached", F.lit(False)).alias("cached"))
