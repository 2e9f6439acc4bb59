"""Joining scored transactions with labels that arrive late."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def label_join(
    scored: DataFrame, labels: DataFrame, key: str = "txn_id", within_hours: int = 72,
    score_delay: str = "10 minutes", label_delay: str = "10 minutes",
) -> DataFrame:
    """Inner stream-stream join on the key; a label counts if it comes within the allowed
    time after the transaction.  Both watermarks and the time range bound the state."""
    s = scored.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", score_delay)
    names = {key: "_key"}
    l = (
        labels.withColumnsRenamed(names).withColumn("label_ts", F.col("label_ts").cast("timestamp"))
        .withWatermark("label_ts", label_delay)
    )
    on = (
        (F.col(key) == F.col("_key"))
        & (F.col("label_ts") >= F.col("ts"))
        & (F.col("label_ts") <= F.col("ts") + F.expr(f"INTERVAL {int(within_hours)} HOURS"))
    )
    return s.join(l, on).drop("_key")
