"""Starting streams with file sinks and batch-numbered, repeatable writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True, interval: str = "1 minute"
) -> StreamingQuery:
    """Append to parquet, exactly once; with ``available_now`` it stops when caught up."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def for_each_batch(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str,
    available_now: bool = True, interval: str = "1 minute",
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per micro-batch, overwritten when the batch is repeated after a failure."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
