"""Training and scoring over the transactions with the shipped settings.

Scores of a boosted model have no SQL; the queries return what has: which rows are scored, that
each score is a probability, and that each decision follows from it. The model is fitted once
per session and table folder, saved, and loaded by every query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.catalog.splitting import _split_views
from riskspark.catalog.tables_sql import TABLES, VIOLATIONS
from riskspark.config import ModelConfig
from riskspark.functions import invalid_score
from riskspark.operators import split as P, train as L
from riskspark.operators.admission import admit
from riskspark.session import scratch_path
from riskspark.sources import testdata as D
from riskspark.streaming import scoring as SS

_saved: dict[tuple[str, str], str] = {}


def _model(s, sf, train: DataFrame | None = None):
    """``train`` saves splitting the table again where the caller has its training rows."""
    place = (s.sparkContext.applicationId, sf)
    if place not in _saved:
        if train is None:
            train, _ = P.train_test(D.transactions(s, sf), "txn_id")
        _saved[place] = L.save_model(L.fit(train, "txn_id", model=ModelConfig()), scratch_path(s, "model"))
    return L.load_model(_saved[place])


def _checked(scored: DataFrame, *keep: str) -> DataFrame:
    """``keep``, whether the score is a probability, and whether the decision follows from it."""
    p = F.col(L.PROBABILITY)
    return scored.select(
        *keep, (~invalid_score(L.PROBABILITY)).alias("is_probability"),
        (F.col("is_fraud") == (p >= F.col("threshold"))).alias("follows_threshold"), "threshold")


def gbt_train_score(s, sf):
    train, test = P.train_test(D.transactions(s, sf), "txn_id")
    return _checked(L.score(test, _model(s, sf, train), keep=["txn_id", "isFraud"]), "txn_id", "isFraud")


def score_transactions(s, sf):
    """The admitted rows of the dirty table through a saved and reloaded pipeline."""
    valid, _ = admit(D.score_requests(s, sf))
    return _checked(L.score(valid, _model(s, sf), keep=["txn_id"]), "txn_id")


def stream_scores(s, sf):
    """The same rows scored on a stream, valid and quarantined ones in one pass."""
    requests = D.score_requests_from(D.transactions_from(D.stream_events(s, sf, only="events.parquet")))
    out, bad, checkpoint = (scratch_path(s, n) for n in ("scored", "quarantine", "scoring-checkpoint"))
    SS.run_scoring(requests, _model(s, sf), out, bad, checkpoint).awaitTermination()
    return _checked(s.read.parquet(out), "txn_id")


_RULE = f"true AS is_probability, true AS follows_threshold, CAST({ModelConfig().threshold} AS DOUBLE) AS threshold"
_ADMITTED = TABLES + VIOLATIONS + f"SELECT txn_id, {_RULE} FROM dirty WHERE txn_id NOT IN (SELECT txn_id FROM violations)"

QUERIES = {
    "gbt_train_score": (
        gbt_train_score,
        TABLES + _split_views("isFraud") + f"SELECT txn_id, isFraud, {_RULE} FROM split WHERE split = 'test'",
    ),
    "score_transactions": (score_transactions, _ADMITTED),
    "stream_score_transactions": (stream_scores, _ADMITTED),
}
