"""Splits, weights and oversampling over the transactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog.shape import rounded
from riskspark.catalog.tables_sql import TABLES
from riskspark.config import SmoteConfig, SplitConfig
from riskspark.operators import encode as C, features as X, neighbours as N, resample as S, split as P
from riskspark.sources import testdata as D

T = D.transactions
RAW_POINT = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")


def _split_views(by: str) -> str:
    """Quotas by largest remainder, then a plain rank by digest."""
    return f""",
cls AS (SELECT {by} AS c, count(*) AS n FROM transactions GROUP BY 1),
tot AS (SELECT sum(n) AS rows, ceil(CAST(0.3 AS DOUBLE) * sum(n)) AS want FROM cls),
quota AS (SELECT c, n, floor(CAST(want AS DOUBLE) * n / rows) AS low, CAST(want AS DOUBLE) * n / rows - floor(CAST(want AS DOUBLE) * n / rows) AS part, want FROM cls, tot),
seats AS (SELECT c, low + CASE WHEN row_number() OVER (ORDER BY part DESC, CAST(c AS VARCHAR)) <= want - sum(low) OVER () THEN 1 ELSE 0 END AS k FROM quota),
placed AS (SELECT txn_id, isFraud, type, row_number() OVER (PARTITION BY {by} ORDER BY md5(concat(CAST(txn_id AS VARCHAR), ':42')), txn_id) AS place, {by} AS c FROM transactions),
split AS (SELECT txn_id, isFraud, CASE WHEN place <= k THEN 'test' ELSE 'train' END AS split FROM placed JOIN seats ON seats.c = placed.c)
"""


def _raw_vector():
    return F.array(*[F.col(c) for c in RAW_POINT])


KNN_SQL = TABLES + """,
pts AS (SELECT txn_id, amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest FROM transactions WHERE isFraud = 1),
pairs AS (SELECT a.txn_id AS id, b.txn_id AS neighbour, """ + " + ".join(
    f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in RAW_POINT
) + """ AS d2 FROM pts a JOIN pts b ON a.txn_id <> b.txn_id),
near AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, neighbour) AS rank FROM pairs)
SELECT id, neighbour, CAST(rank AS INT) AS rank, round(sqrt(d2), 6) AS distance FROM near WHERE rank <= 5"""


def smote_knn(s, sf):
    fraud = T(s, sf).where("isFraud = 1").select("txn_id", *RAW_POINT)
    found = N.nearest_neighbours(fraud, "txn_id", _raw_vector(), 5, block_rows=256)
    return rounded(found.select("id", "neighbour", "rank", "distance"))


def smote_sample(s, sf):
    """Synthetic training frauds in the scaled and one-hot space: how many each fraud is the base
    of, and whether all lie on the way to a neighbour that is another training fraud."""
    train, _ = P.train_test(T(s, sf), "txn_id")
    featured = X.add_features(train)
    numbers = C.standardize(featured)
    hot = C.one_hot("type", C.categories(train, "type"))
    vector = F.array(*[F.col(c) for c in C.NUMERIC_FEATURES], *hot.values())
    rows = numbers.select("txn_id", "isFraud", vector.alias("features"))
    made = S.smote(rows, "txn_id", "features", "isFraud", SmoteConfig())
    frauds = rows.where("isFraud = 1")
    ends = made.join(frauds.select(F.col("txn_id").alias("base"), F.col("features").alias("a")), "base").join(
        frauds.select(F.col("txn_id").alias("neighbour"), F.col("features").alias("b")), "neighbour")
    way = F.zip_with("a", "b", lambda x, y: x + F.col("gap") * (y - x))
    gaps = F.zip_with("features", way, lambda x, y: F.abs(x - y) < 1e-9)
    between = F.forall(gaps, lambda ok: ok) & (F.col("base") != F.col("neighbour")) & (F.col("gap") >= 0) & (F.col("gap") < 1)
    return ends.groupBy("base").agg(F.count("*").alias("rows"), F.bool_and(between).alias("on_segment"),
                                    F.max("isFraud").alias("isFraud"))


def smote_balance(s, sf):
    """Class counts of the training rows before and after oversampling."""
    train, _ = P.train_test(T(s, sf), "txn_id")
    rows = train.select("txn_id", "isFraud", _raw_vector().alias("features"))
    made = S.smote(rows, "txn_id", "features").select("isFraud", F.lit(1).alias("synthetic"))
    return (
        rows.select("isFraud", F.lit(0).alias("synthetic")).unionByName(made)
        .groupBy("isFraud").agg(F.count("*").alias("rows"), F.sum("synthetic").cast("bigint").alias("synthetic"))
    )


QUERIES = {
    "stratified_split": (
        lambda s, sf: P.assign_split(T(s, sf), "txn_id").select("txn_id", "isFraud", "split"),
        TABLES + _split_views("isFraud") + "SELECT * FROM split",
    ),
    "random_split": (
        lambda s, sf: P.assign_split(T(s, sf), "txn_id", config=SplitConfig(stratify=False)).select("txn_id", "isFraud", "split"),
        TABLES + _split_views("0") + "SELECT * FROM split",
    ),
    "split_by_type": (
        lambda s, sf: P.split_audit(P.assign_split(T(s, sf), "txn_id", "type"), "type"),
        TABLES + _split_views("type") + "SELECT split, type, count(*) AS rows FROM split JOIN transactions USING (txn_id) GROUP BY ALL",
    ),
    "split_audit": (
        lambda s, sf: P.split_audit(P.assign_split(T(s, sf), "txn_id")),
        TABLES + _split_views("isFraud") + "SELECT split, isFraud, count(*) AS rows FROM split GROUP BY ALL",
    ),
    "class_weights": (
        lambda s, sf: rounded(P.class_weight_table(P.train_test(T(s, sf), "txn_id")[0])),
        TABLES + _split_views("isFraud") + """SELECT count(*) FILTER (WHERE isFraud = 0) AS negatives, count(*) FILTER (WHERE isFraud = 1) AS positives,
        round(CAST(count(*) FILTER (WHERE isFraud = 0) AS DOUBLE) / count(*) FILTER (WHERE isFraud = 1), 6) AS positive_weight
        FROM split WHERE split = 'train'""",
    ),
    "smote_knn": (smote_knn, KNN_SQL),
    "smote_balance": (
        smote_balance,
        TABLES + _split_views("isFraud") + """, n AS (SELECT count(*) FILTER (WHERE isFraud = 0) AS n0, count(*) FILTER (WHERE isFraud = 1) AS n1 FROM split WHERE split = 'train')
        SELECT CAST(0 AS INT) AS isFraud, n0 AS rows, CAST(0 AS BIGINT) AS synthetic FROM n UNION ALL SELECT 1, n0, n0 - n1 FROM n""",
    ),
    "smote_sample": (
        smote_sample,
        TABLES + _split_views("isFraud") + """, n AS (SELECT count(*) FILTER (WHERE isFraud = 0) - count(*) FILTER (WHERE isFraud = 1) AS missing,
          count(*) FILTER (WHERE isFraud = 1) AS n1 FROM split WHERE split = 'train'),
        f AS (SELECT txn_id, row_number() OVER (ORDER BY md5(concat(CAST(txn_id AS VARCHAR), ':42')), txn_id) AS place FROM split WHERE split = 'train' AND isFraud = 1),
        c AS (SELECT txn_id AS base, CAST(missing // n1 + CASE WHEN place <= missing % n1 THEN 1 ELSE 0 END AS BIGINT) AS rows FROM f, n)
        SELECT base, rows, true AS on_segment, CAST(1 AS INT) AS isFraud FROM c WHERE rows > 0""",
    ),
}
