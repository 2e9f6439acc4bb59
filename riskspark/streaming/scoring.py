"""Admission, quarantine and scoring of a request stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.config import OPERATING_THRESHOLD
from riskspark.operators.admission import VIOLATIONS, admit, with_violations
from riskspark.operators.train import score
from riskspark.streaming.run import for_each_batch, write_batch


def admitted(requests: DataFrame) -> DataFrame:
    """Requests without any violation, numbers parsed; stateless."""
    return admit(requests)[0]


def quarantined(requests: DataFrame) -> DataFrame:
    """Requests with their violations; stateless."""
    return with_violations(requests).where(F.size(VIOLATIONS) > 0)


def score_stream(requests: DataFrame, model: PipelineModel, threshold: float = OPERATING_THRESHOLD) -> DataFrame:
    """Scores of the admitted requests; the same projection as a batch run."""
    return score(admitted(requests), model, threshold)


def run_scoring(
    requests: DataFrame, model: PipelineModel, scored_path: str, quarantine_path: str, checkpoint: str,
    threshold: float = OPERATING_THRESHOLD, available_now: bool = True,
) -> StreamingQuery:
    """Score valid rows and quarantine the rest, reading each micro-batch once."""
    def work(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            valid, bad = admit(batch)
            write_batch(score(valid, model, threshold), scored_path, batch_id)
            write_batch(bad, quarantine_path, batch_id)
        finally:
            batch.unpersist()

    return for_each_batch(requests, work, checkpoint, available_now)
