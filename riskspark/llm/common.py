"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskspark.session import scratch_path

# files of one bucketed table, at most about
BUCKET_FILES = 100_000
BUCKET_BYTES = 256_000_000


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: its lineage ends at files that
    outlive any executor, and it is computed once however often it is used."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Let the driver collect its garbage now: shuffle files of steps whose result is written, and
    whose DataFrames are gone, are deleted instead of lying until it happens to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names; null text counts as empty."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        *[F.col(f"`{c}`") for c in more],
    )


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The hash of id and text by which operators name a row in their ``row`` column."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def id_kind(docs: DataFrame, id_col: str = "doc_id") -> str:
    """The type of the id column as SQL text: ids are carried as they are."""
    return docs.schema[id_col].dataType.simpleString()


def free_name(docs: DataFrame, wanted: str) -> str:
    """``wanted``, made longer until no column of ``docs`` has that name in any case."""
    taken = {c.lower() for c in docs.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def keep_rows(docs: DataFrame, rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` whose row key is among ``rows.row``; all columns kept. The key holds the id, so
    copies of one text spread over tasks; the kept rows grow with the corpus and are not sent whole."""
    name = free_name(docs, "__row")
    named = docs.withColumn(name, row_key(id_col, text_col))
    wanted = rows.select(F.col("row").alias(name)).hint("merge")
    return named.join(wanted, name, "left_semi").drop(name)


def bucketed(df: DataFrame, column: str, name: str, size: int = 0) -> DataFrame:
    """``df`` written as a table bucketed by ``column``: later joins on it move only their other
    side. A bucket is read by one task, so ``size`` bytes make at least one bucket per ``BUCKET_BYTES``.
    Every write task opens a file per bucket; where tasks x buckets would make too many
    files, rows are sent to their buckets first, so that each bucket is one file."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(size // BUCKET_BYTES + 1, BUCKET_FILES))
    if df.rdd.getNumPartitions() * n > BUCKET_FILES:
        df = df.repartition(n, column)
    df.write.option("compression", "zstd").bucketBy(n, column).saveAsTable(table)
    return spark.table(table)
