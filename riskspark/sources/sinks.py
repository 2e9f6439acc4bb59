"""Table, report and decision-log writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from riskspark.functions import small_table


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def as_json(report: DataFrame) -> DataFrame:
    """Every row as one JSON text in column ``value``; nulls kept."""
    return report.select(
        F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"}).alias("value")
    )


def write_report(report: DataFrame, path: str) -> str:
    report.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def append_decisions(decisions: DataFrame, path: str, run: str | None = None, keys: Sequence[str] = ()) -> str:
    """Add gate decisions to the log; earlier records are never rewritten.

    ``run`` names the job and ``keys`` the columns that tell its decisions apart (none: it makes
    one). Their digest is the ``decision_id``, so a job that is run again under its name adds
    nothing. Without ``run`` every call makes decisions of their own.
    """
    spark = decisions.sparkSession
    name = F.uuid() if run is None else F.sha2(F.to_json(F.struct(F.lit(run).alias("run"), *keys), {"ignoreNullFields": "false"}), 256)
    new = decisions.withColumns({"decision_id": name, "recorded_at": F.current_timestamp()})
    if run is not None and _exists(spark, path):
        logged = spark.read.option("mergeSchema", "true").parquet(path)
        if "decision_id" in logged.columns:
            new = new.join(logged.select("decision_id"), "decision_id", "left_anti").select(*new.columns)
    new.write.mode("append").parquet(path)
    return path


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """One row per decision: where two tries of a job wrote at the same time, the earlier record.
    Records of older logs, without an id, stand each."""
    log = spark.read.option("mergeSchema", "true").parquet(path)
    if "decision_id" not in log.columns:
        return log
    whole = F.struct(*log.columns)
    first = log.where("decision_id IS NOT NULL").groupBy("decision_id").agg(F.min_by(whole, "recorded_at").alias("r"))
    return first.select("r.*").unionByName(log.where("decision_id IS NULL"))


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def write_with_stage_report(
    before: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, stage: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``step(before)`` and report the stage from that one pass; rows are counted where
    they enter and where they leave."""
    came, left = Observation(f"{stage}-in"), Observation(f"{stage}-out")
    rows = F.count(F.lit(1)).alias("rows")
    after = step(before.observe(came, rows))
    write_table(after.observe(left, rows), path, partition_by)
    rows_in, rows_out = came.get["rows"], left.get["rows"]
    size = _bytes_under(before.sparkSession, path)
    return small_table(
        before.sparkSession,
        [(stage, rows_in, len(before.columns), rows_out, len(after.columns),
          [c for c in before.columns if c not in after.columns],
          [c for c in after.columns if c not in before.columns],
          list(after.columns), path, round(size / 1048576, 2), "SUCCESS")],
        "stage string, input_rows bigint, input_columns int, output_rows bigint, "
        "output_columns int, features_removed array<string>, features_created array<string>, "
        "final_columns array<string>, output_path string, file_size_mb double, status string",
    )


def _bytes_under(spark: SparkSession, path: str) -> int:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop_path).getLength()
