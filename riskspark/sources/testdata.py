"""The given tables seen as transactions, dirty transactions, scores and a request log.

Pure projections of ``events`` (or ``lineitem``): no join, no shuffle, so whatever runs
on top keeps column pruning down to the parquet scan.  Money is built in integer cents
and divided once, so doubles are the same in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskspark.schema import EVENTS


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None, only: str = "*.parquet"
) -> DataFrame:
    """Files of a folder whose names match, as a stream of events."""
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", only)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def lineitem_as_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` in the shape of ``events``, for runs on more rows."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    kinds = F.array(*[F.lit(k) for k in ("signup", "click", "view", "purchase", "error")])
    event_id = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return li.select(
        event_id.alias("event_id"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_suppkey").alias("user_id"),
        F.element_at(kinds, (F.pmod(F.col("l_partkey"), F.lit(5)) + 1).cast("int")).alias("event_type"),
        (F.col("l_extendedprice") / 100).alias("value"),
        F.lit(None).cast("string").alias("props"),
    )


def _cents(c: Column) -> Column:
    return c.cast("double") / F.lit(100.0)


def transactions_from(ev: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    e = ev.select(
        "event_id", "ts", "user_id",
        F.round(F.col("value") * F.lit(100.0)).cast("bigint").alias("amt_c"),
        F.when(kind == "signup", "CASH_IN").when(kind == "click", "CASH_OUT")
        .when(kind == "view", "DEBIT").when(kind == "purchase", "PAYMENT")
        .otherwise("TRANSFER").alias("type"),
    )
    drain = F.col("type").isin("TRANSFER", "CASH_OUT") & (F.col("event_id") % 11 == 0)
    e = e.withColumns({
        "drain": drain,
        "oo_c": F.when(drain, F.col("amt_c")).otherwise((F.col("event_id") * 7919) % 100000),
        "od_c": F.when(F.col("type") == "PAYMENT", F.lit(0).cast("bigint"))
        .otherwise((F.col("event_id") * 104729) % 200000),
    })
    left = F.col("oo_c") - F.col("amt_c")
    return e.select(
        F.col("event_id").alias("txn_id"),
        "ts",
        ((F.dayofmonth("ts") - 1) * 24 + F.hour("ts") + 1).cast("bigint").alias("step"),
        "type",
        _cents(F.col("amt_c")).alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        _cents(F.col("oo_c")).alias("oldbalanceOrg"),
        _cents(F.when(F.col("type") == "CASH_IN", F.col("oo_c") + F.col("amt_c"))
               .otherwise(F.greatest(left, F.lit(0).cast("bigint")))).alias("newbalanceOrig"),
        F.concat(F.when(F.col("type") == "PAYMENT", "M").otherwise("C"),
                 (F.col("event_id") % 131).cast("string")).alias("nameDest"),
        _cents(F.col("od_c")).alias("oldbalanceDest"),
        _cents(F.when(F.col("drain"), F.col("od_c"))
               .otherwise(F.col("od_c") + F.col("amt_c"))).alias("newbalanceDest"),
        (F.col("drain") & (F.col("amt_c") > 2000)).cast("int").alias("isFraud"),
        ((F.col("type") == "TRANSFER") & (F.col("amt_c") > 20000)).cast("int").alias("isFlaggedFraud"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from(events(spark, sf_dir))


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from(lineitem_as_events(spark, sf_dir))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly the eleven raw columns."""
    return transactions(spark, sf_dir).drop("txn_id", "ts")


def dirty_from(t: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Transactions with every kind of failure at a fixed rate, and whole-row copies."""
    def every(n: int) -> Column:
        return F.col("txn_id") % n == 0

    null = F.lit(None)
    rows = t.select(
        "txn_id", *keep,
        F.when(every(523), F.lit(0).cast("bigint")).otherwise(F.col("step")).alias("step"),
        F.when(every(499), "UNKNOWN").when(every(491), null).otherwise(F.col("type")).alias("type"),
        F.when(every(503), -F.col("amount") - 1).when(every(509), null)
        .otherwise(F.col("amount")).alias("amount"),
        F.when(every(563), "one hundred").when(every(569), null)
        .otherwise(F.round(F.col("amount") * F.lit(100.0)).cast("bigint").cast("string"))
        .alias("amount_cents_text"),
        "nameOrig",
        F.when(every(521), F.lit(-1.0)).otherwise(F.col("oldbalanceOrg")).alias("oldbalanceOrg"),
        "newbalanceOrig", "nameDest", "oldbalanceDest", "newbalanceDest",
        F.when(every(541), 2).when(every(547), null).otherwise(F.col("isFraud")).alias("isFraud"),
        "isFlaggedFraud",
    )
    copies = F.when(every(557), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_from(transactions(spark, sf_dir))


def score_requests_from(t: DataFrame) -> DataFrame:
    """Dirty rows as scoring requests whose amount is still text; keeps ``ts`` when there is one."""
    text = F.when(F.col("amount_cents_text") == "one hundred", F.col("amount_cents_text")).otherwise(
        F.col("amount").cast("string")
    )
    return dirty_from(t, keep=("ts",)).withColumn("amount", text)


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_requests_from(transactions(spark, sf_dir))


def scored_from(t: DataFrame) -> DataFrame:
    def score(step: int, low: int, high: int) -> Column:
        return ((F.col("txn_id") * step) % low + high * F.col("isFraud")).cast("double") / F.lit(1000.0)

    return t.select(
        "txn_id", "ts", "type", F.col("isFraud").alias("y"),
        score(7919, 700, 300).alias("p_candidate"),
        score(6007, 800, 200).alias("p_champion"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_from(transactions(spark, sf_dir))


def requests_from(ev: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    amt_c = F.round(F.col("value") * F.lit(100.0)).cast("bigint")
    fraud = (
        kind.isin("click", "error") & (F.col("event_id") % 11 == 0) & (amt_c > 2000)
    ).cast("int")
    probability = ((F.col("event_id") * 7919) % 700 + 300 * fraud).cast("double") / F.lit(1000.0)
    return ev.select(
        F.col("event_id").alias("request_id"),
        "ts",
        F.when(kind.isin("view", "signup"), "GET").otherwise("POST").alias("method"),
        F.when(kind == "view", "/health").when(kind == "signup", "/model-info")
        .otherwise("/predict").alias("path"),
        F.when(kind != "error", 200).when(F.col("event_id") % 3 == 0, 422)
        .when(F.col("event_id") % 3 == 1, 500).otherwise(503).alias("status"),
        F.col("value").alias("latency_ms"),
        F.when(kind.isin("click", "purchase"), probability).alias("probability"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from(events(spark, sf_dir))


def late_labels_from(t: DataFrame) -> DataFrame:
    """Fraud labels that arrive up to 71 hours after the transaction; every fifth never does."""
    delay = F.make_dt_interval(hours=(F.col("txn_id") % 72).cast("int"))
    return t.where(F.col("txn_id") % 5 != 0).select(
        "txn_id", (F.col("ts") + delay).alias("label_ts"), F.col("isFraud").alias("y")
    )


def drift_pair(features: DataFrame, boundary: int = 360) -> tuple[DataFrame, DataFrame]:
    """Reference: steps up to the boundary; current: later steps, amounts doubled, one type."""
    reference = features.where(F.col("step") <= boundary)
    current = features.where(F.col("step") > boundary).withColumns(
        {"amount": F.col("amount") * 2, "type": F.lit("TRANSFER")}
    )
    return reference, current
