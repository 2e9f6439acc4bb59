"""Drift of each micro-batch against a fixed reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.config import DriftConfig
from riskspark.operators.admission import require_drift_input
from riskspark.operators.drift_index import build_index, index_drift
from riskspark.session import scratch_path
from riskspark.streaming.run import for_each_batch, write_batch


def run_drift(
    features: DataFrame, reference: DataFrame, path: str, checkpoint: str,
    config: DriftConfig = DriftConfig(), available_now: bool = True, ts: str | None = "ts", index_path: str | None = None,
) -> StreamingQuery:
    """Write one row per feature and micro-batch.

    The reference is checked and indexed once; each batch reads the cells of the index that its values touch.
    A stream that is started again with the same ``index_path`` takes the index that is there.
    A batch that cannot be compared (a missing or infinite value) stops the stream.
    """
    columns = [*config.categorical, *config.numeric]
    require_drift_input(reference, "reference", columns, config.numeric)
    index = build_index(reference.select(*columns), index_path or scratch_path(reference.sparkSession, "drift-index"),
                        config.numeric, config.categorical)

    def work(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            rows = require_drift_input(batch, f"batch {batch_id}", columns, config.numeric)
            result = index_drift(index, batch, config).withColumn("rows", F.lit(rows).cast("bigint"))
            if ts:
                span = batch.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
                result = result.withColumns({"from_ts": F.lit(span.lo), "to_ts": F.lit(span.hi)})
            write_batch(result, path, batch_id)
        finally:
            batch.unpersist()

    return for_each_batch(features, work, checkpoint, available_now)
