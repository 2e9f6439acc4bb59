"""The scoring-request log as a table, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from riskspark.schema import REQUEST_LOG


def read_request_log(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = REQUEST_LOG
) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def stream_request_log(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = REQUEST_LOG,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The same log as a stream of arriving files."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def write_request_log(df: DataFrame, path: str) -> str:
    df.select(*REQUEST_LOG.fieldNames()).write.mode("append").parquet(path)
    return path
