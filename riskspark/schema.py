"""Declared schemas of the tables the operators read."""

from pyspark.sql import types as T


TRANSACTION = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("isFraud", T.IntegerType()),
    T.StructField("isFlaggedFraud", T.IntegerType()),
])

# A scoring request as it arrives: numbers still as text.
SCORE_REQUEST_TEXT = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("type", "amount", "oldbalanceOrg", "newbalanceOrig",
                 "oldbalanceDest", "newbalanceDest")
])

REQUEST_LOG = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("method", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("probability", T.DoubleType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
