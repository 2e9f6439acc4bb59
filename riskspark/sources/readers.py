"""Table readers: declared schemas, failures as report rows, format by suffix."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskspark.config import FEATURES
from riskspark.errors import DriftDataError
from riskspark.functions import hash_key, small_table
from riskspark.plans import below_cut, lowest_hash_cuts
from riskspark.schema import TRANSACTION

CORRUPT = "_corrupt_record"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path (or glob) names anything, on whatever file system it lies."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TRANSACTION,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Header CSV with a declared schema, so there is no inference pass over the file.

    Lines that do not fit become null fields; with ``keep_corrupt`` the raw line is kept
    in ``_corrupt_record``.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV whose column types Spark infers: the input of a data-type check."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_text_or_report(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """(table of text, None), or (None, one-row FAILED report) when the file cannot be read. Nothing but the
    header is read yet."""
    if not path_exists(spark, path):
        return None, failed_report(spark, f"no file at {path}")
    try:
        return spark.read.option("header", True).csv(path), None
    except (Py4JJavaError, PySparkException) as error:
        return None, failed_report(spark, f"unreadable: {str(error).splitlines()[0]}")


def failed_report(spark: SparkSession, message: str) -> DataFrame:
    return small_table(
        spark,
        [("overall", None, "FAILED", None, message)],
        "check string, item string, status string, value double, detail string",
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV by suffix; anything else is an error."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    lower = path.rstrip("/").lower()
    if lower.endswith((".parquet", ".pq")):
        return spark.read.parquet(path)
    if lower.endswith(".csv"):
        return read_csv_inferred(spark, path)
    raise DriftDataError(f"unsupported data format: {path}")


def drift_columns(df: DataFrame, target: str = "isFraud", features: Sequence[str] = FEATURES) -> DataFrame:
    """Only the features (and target) that exist; the scan reads no other column."""
    return df.select(*[c for c in (*features, target) if c in df.columns])


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones however the files are laid out."""
    cuts = lowest_hash_cuts(df, key, lambda totals: {c: min(n, t) for c, t in totals.items()}, seed=seed)
    return df.where(below_cut(cuts, key, seed=seed))


def sample_contents(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows of a table without a key, the same ones however the files are laid out.

    Rows are ordered by a digest of their content. Equal rows share it, so the cut says besides how many of the
    rows at the cut itself are taken; they are alike, so that many copies of one of them are made.
    """
    content = "_content"
    keyed = df.withColumn(content, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    cut = lowest_hash_cuts(keyed, content, lambda totals: {c: min(n, t) for c, t in totals.items()}, seed=seed)
    if not cut or cut[0].rows >= cut[0].class_rows:
        return df if cut else df.limit(0)
    at = F.lit(cut[0].digest)
    digest = hash_key(content, seed)
    below = keyed.where(digest < at).drop(content)
    missing = min(n, cut[0].class_rows) - below.count()
    one = keyed.where(digest == at).drop(content).limit(1)
    copies = df.sparkSession.range(missing).select(F.lit(1).alias("_one"))
    # a single row
    tied = copies.join(F.broadcast(one.withColumn("_same", F.lit(1))), F.col("_one") == F.col("_same")).drop("_one", "_same")
    return below.unionByName(tied)


def load_drift_table(
    spark: SparkSession,
    path: str,
    sample_size: int | None = None,
    key: str | None = None,
    seed: int = 42,
) -> DataFrame:
    """A table for drift comparison: all rows, or an exact reproducible sample by ``key``.

    Without a key the row's own content orders the sample.
    """
    df = read_table(spark, path)
    if not sample_size:
        return drift_columns(df)
    if key:
        return drift_columns(sample_rows(df, key, sample_size, seed))
    return sample_contents(drift_columns(df), sample_size, seed)
