"""Rule-based table validation.

Schema rules need no job.  Every counting rule is one expression of a single
aggregation over the table; only duplicate detection shuffles.  Reports are long:
(check, item, status, value, detail).
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskspark.config import ValidationRules
from riskspark.errors import DataValidationError
from riskspark.functions import count_where, is_missing, is_numeric, is_string, small_table

REPORT_SCHEMA = "check string, item string, status string, value double, detail string"
# Hashes seen more than once become a literal table up to this many (8 bytes each).
LITERAL_HASHES = 20_000


def _rows(one_row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*entries)))


def _status(failed: Column, bad: str = "FAILED") -> Column:
    return F.when(failed, bad).otherwise("PASSED")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole; null for an empty table."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


# --- schema: no job ---------------------------------------------------------------

def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def unexpected_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(df.columns) - set(required))


def schema_report(df: DataFrame, rules: ValidationRules = ValidationRules()) -> DataFrame:
    """Required columns and data types, from the schema alone."""
    return small_table(df.sparkSession, _schema_rows(_types(df), rules), REPORT_SCHEMA)


def _schema_rows(columns: dict[str, T.DataType], rules: ValidationRules) -> list[tuple]:
    missing = sorted(set(rules.required) - set(columns))
    rows = [("schema", None, "FAILED" if missing else "PASSED", float(len(missing)), None)]
    rows += [("schema", c, "FAILED", None, "missing column") for c in missing]
    rows += [("schema", c, "INFO", None, "unexpected column") for c in sorted(set(columns) - set(rules.required))]
    wrong = 0
    type_rows = []
    for wanted, names, fits in (("numeric", rules.numeric, is_numeric), ("string", rules.string, is_string)):
        for name in names:
            if name in columns:
                ok = fits(columns[name])
                wrong += not ok
                type_rows.append(("data_types", name, "PASSED" if ok else "FAILED", None,
                                  f"expected {wanted}, found {columns[name].simpleString()}"))
    rows.append(("data_types", None, "FAILED" if wrong else "PASSED", float(wrong), None))
    return rows + type_rows


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


# --- counting rules: one aggregation ----------------------------------------------

def _numeric_minimums(df: DataFrame, rules: ValidationRules) -> dict[str, float]:
    return {c: low for c, low in rules.minimums.items()
            if c in df.columns and is_numeric(df.schema[c].dataType)}


def profile(df: DataFrame, rules: ValidationRules = ValidationRules()) -> DataFrame:
    """One row with every count the rules need, from one pass over the table."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [count_where(is_missing(f.name, f.dataType)).alias(f"null__{f.name}") for f in df.schema]
    aggs += [count_where(F.col(c) < F.lit(low)).alias(f"low__{c}")
             for c, low in _numeric_minimums(df, rules).items()]
    if rules.target in df.columns:
        t = F.col(rules.target)
        present = ~is_missing(rules.target, df.schema[rules.target].dataType)
        aggs += [
            count_where(present & ~t.isin(*rules.allowed_targets)).alias("bad_target"),
            count_where(t == 1).alias("fraud"),
            count_where(t == 0).alias("non_fraud"),
        ]
    return df.agg(*aggs)


def size_report(df: DataFrame) -> DataFrame:
    """Rows and columns; FAILED when either is zero."""
    columns = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(columns).cast("bigint").alias("columns"),
        _status((F.col("rows") == 0) | F.lit(columns == 0)).alias("status"),
    )


def null_report(df: DataFrame) -> DataFrame:
    """Missing values per column; at worst a WARNING."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[count_where(is_missing(f.name, f.dataType)).alias(f"null__{f.name}") for f in df.schema],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"null__{c}").alias("nulls"),
                 percent(F.col(f"null__{c}"), F.col("rows")).alias("null_percent"),
                 _status(F.col(f"null__{c}") > 0, "WARNING").alias("status"))
        for c in df.columns
    ]
    return _rows(counts, entries)


def sanity_report(df: DataFrame, rules: ValidationRules = ValidationRules()) -> DataFrame:
    """Values below their minimum, per rule; missing values do not count."""
    minimums = _numeric_minimums(df, rules)
    if not minimums:
        return small_table(df.sparkSession, [], "column string, violations bigint, status string")
    counts = df.agg(*[count_where(F.col(c) < F.lit(low)).alias(c) for c, low in minimums.items()])
    return _rows(counts, [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("violations"),
                 _status(F.col(c) > 0).alias("status"))
        for c in minimums
    ])


def target_domain(df: DataFrame, rules: ValidationRules = ValidationRules()) -> DataFrame:
    """Every target value with its count and whether it is allowed."""
    t = rules.target
    present = ~is_missing(t, df.schema[t].dataType)
    return (
        df.where(present).groupBy(F.col(t).alias("value")).agg(F.count("*").alias("rows"))
        .withColumn("allowed", F.col("value").isin(*rules.allowed_targets))
    )


def class_distribution(df: DataFrame, target: str = "isFraud") -> DataFrame:
    """Counts of both classes, fraud percentage of all rows, and their ratio."""
    t = F.col(target)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        count_where(t == 0).alias("non_fraud"),
        count_where(t == 1).alias("fraud"),
    ).withColumns({
        "fraud_percent": F.coalesce(percent(F.col("fraud"), F.col("rows")), F.lit(0.0)),
        "imbalance_ratio": F.try_divide(F.col("non_fraud").cast("double"), F.col("fraud").cast("double")),
    })


# --- duplicates: the only shuffle ----------------------------------------------------

def _row_hash(df: DataFrame) -> Column:
    """A 64-bit hash that equal rows share; -0.0 equals 0.0."""
    def stable(f: T.StructField) -> Column:
        floating = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        return F.col(f.name) + F.lit(0.0).cast(f.dataType) if floating else F.col(f.name)

    return F.xxhash64(*[stable(f) for f in df.schema])


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier fully equal row (nulls equal): one row, exact.

    Equal rows have equal hashes, so only rows whose hash occurs twice can be copies.
    The first pass shuffles 8 bytes per row instead of whole rows; the second groups the
    suspects by all columns.  Copies collapse before the shuffle in both.
    """
    spark = df.sparkSession
    hashed = df.withColumn("_h", _row_hash(df))
    repeated = hashed.groupBy("_h").agg(F.count("*").alias("n")).where("n > 1").select("_h")
    found = repeated.limit(LITERAL_HASHES + 1).toArrow()
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    if found.num_rows == 0:
        copies = spark.range(1).select(F.lit(0).cast("bigint").alias("duplicates"))
    else:
        # few: a literal table of known size; many: a shuffled join by hash
        side = spark.createDataFrame(found) if found.num_rows <= LITERAL_HASHES else repeated
        copies = (
            hashed.join(side, "_h", "left_semi").groupBy(*df.columns)
            .agg((F.count("*") - 1).alias("extra"))
            .agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("bigint").alias("duplicates"))
        )
    zero = F.lit(0).cast("bigint")
    both = rows.select("rows", zero.alias("duplicates")).unionByName(copies.select(zero.alias("rows"), "duplicates"))
    return both.agg(F.sum("rows").alias("rows"), F.sum("duplicates").alias("duplicates")).select(
        "rows", "duplicates",
        F.coalesce(percent(F.col("duplicates"), F.col("rows")), F.lit(0.0)).alias("duplicate_percent"),
        _status(F.col("duplicates") > 0, "WARNING").alias("status"),
    )


# --- text tables: types and counts from one pass --------------------------------------------

#: Types a column of text may turn out to have, in the order they are tried; text where none fits.
TEXT_TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


def text_profile(df: DataFrame, rules: ValidationRules = ValidationRules()) -> tuple[dict[str, T.DataType], dict[str, int]]:
    """(type of each text column, the counts of ``profile``) from one pass over a table of text.

    A column has the first of ``TEXT_TYPES`` to which no value fails to convert; one without values is text.
    Counts that need numbers are taken of the values as numbers and used where the column turns out numeric.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in df.columns:
        text, number = F.col(f"`{c}`"), F.expr(f"try_cast(`{c}` AS double)")
        aggs += [F.count(text).alias(f"some__{c}"), count_where(F.isnan(number)).alias(f"nan__{c}")]
        aggs += [count_where(text.isNotNull() & F.expr(f"try_cast(`{c}` AS {t}) IS NULL")).alias(f"{t}__{c}") for t in TEXT_TYPES]
        if c in rules.minimums:
            aggs.append(count_where(~F.isnan(number) & (number < F.lit(float(rules.minimums[c])))).alias(f"low__{c}"))
    if rules.target in df.columns:
        t = F.expr(f"try_cast(`{rules.target}` AS double)")
        some = F.col(f"`{rules.target}`").isNotNull() & ~F.coalesce(F.isnan(t), F.lit(False))
        allowed = F.coalesce(t.isin(*[float(x) for x in rules.allowed_targets]), F.lit(False))
        aggs += [count_where(some & ~allowed).alias("bad_target"), count_where(t == 1).alias("fraud"), count_where(t == 0).alias("non_fraud")]
    found = df.agg(*aggs).first().asDict()

    def kind(c: str) -> T.DataType:
        fits = [of for t, of in TEXT_TYPES.items() if found[f"{t}__{c}"] == 0]
        return fits[0] if fits and found[f"some__{c}"] else T.StringType()

    types = {c: kind(c) for c in df.columns}
    counts = {k: found[k] for k in ("rows", "bad_target", "fraud", "non_fraud") if k in found}
    for c, of in types.items():
        counts[f"null__{c}"] = found["rows"] - found[f"some__{c}"] + (found[f"nan__{c}"] if isinstance(of, T.DoubleType) else 0)
        if f"low__{c}" in found:
            counts[f"low__{c}"] = found[f"low__{c}"]
    return types, counts


def typed(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """A table of text with its columns as ``types``."""
    return df.select(*[F.col(f"`{c}`").cast(of).alias(c) for c, of in types.items()])


def validate_text(df: DataFrame, rules: ValidationRules = ValidationRules()) -> DataFrame:
    """``validate`` of a table whose columns are all text: one pass finds types and counts, one the duplicates."""
    types, counts = text_profile(df, rules)
    return _report(df.sparkSession, types, counts, duplicate_count(typed(df, types)).first(), rules)


# --- the whole report --------------------------------------------------------------------

def validate(df: DataFrame, rules: ValidationRules = ValidationRules()) -> DataFrame:
    """All checks and the overall verdict as one long report.

    The counts come from one aggregation and one duplicate search, one row each; the report
    is filled from them.
    """
    return _report(df.sparkSession, _types(df), profile(df, rules).first().asDict(), duplicate_count(df).first(), rules)


def _report(spark: SparkSession, columns: dict[str, T.DataType], counts: dict, copies, rules: ValidationRules) -> DataFrame:
    rows = counts["rows"]

    def verdict(count: int, bad: str = "FAILED") -> str:
        return bad if count else "PASSED"

    def share(count: int) -> float | None:
        return 100.0 * count / rows if rows else None

    def entry(check: str, item: str | None, status: str, value: float | None, detail: str | None = None) -> tuple:
        return check, item, status, None if value is None else float(value), detail

    nulls = {c: counts[f"null__{c}"] for c in columns}
    low = {c: counts[f"low__{c}"] for c in rules.minimums if c in columns and is_numeric(columns[c])}
    checks = [
        entry("dataset_size", "rows", verdict(rows == 0), rows),
        entry("dataset_size", "columns", verdict(not columns), len(columns)),
        entry("null_values", None, verdict(sum(nulls.values()), "WARNING"), sum(nulls.values())),
        *[entry("null_values", c, verdict(n, "WARNING"), n, f"{share(n):.6f}%" if rows else None)
          for c, n in nulls.items()],
        entry("duplicates", None, copies.status, copies.duplicates),
        entry("duplicates", "percent", "INFO", copies.duplicate_percent),
        entry("numerical_sanity", None, verdict(sum(low.values())), sum(low.values())),
        *[entry("numerical_sanity", c, verdict(n), n) for c, n in low.items()],
    ]
    if rules.target in columns:
        checks += [
            entry("target_column", rules.target, verdict(counts["bad_target"]), counts["bad_target"]),
            entry("target_column", "fraud", "INFO", counts["fraud"]),
            entry("target_column", "non_fraud", "INFO", counts["non_fraud"]),
            entry("target_column", "fraud_percent", "INFO", share(counts["fraud"]) or 0.0),
        ]
    else:
        checks.append(entry("target_column", rules.target, "FAILED", None, "missing column"))
    checks = _schema_rows(columns, rules) + checks
    failed = sum(c[2] == "FAILED" for c in checks)
    checks.append(entry("overall", None, verdict(failed), failed))
    return small_table(spark, checks, REPORT_SCHEMA)


def overall_status(report: DataFrame) -> str:
    return report.where("check = 'overall'").first().status


def require_valid(df: DataFrame, rules: ValidationRules = ValidationRules()) -> DataFrame:
    """The table itself, or an error that lists the failed checks."""
    failed = validate(df, rules).where("status = 'FAILED' AND check <> 'overall'").collect()
    if failed:
        raise DataValidationError(
            "; ".join(f"{r.check}/{r.item or '*'}: {r.detail or r.value}" for r in failed)
        )
    return df


def validate_csv(spark: SparkSession, path: str, rules: ValidationRules = ValidationRules()) -> DataFrame:
    """Validate a CSV file; an unreadable file gives a FAILED report, not an exception."""
    from riskspark.sources.readers import failed_report, read_csv_text_or_report

    df, failure = read_csv_text_or_report(spark, path)
    if failure is not None:
        return failure
    try:
        return validate_text(df, rules)
    except (Py4JJavaError, PySparkException) as error:  # files that open but do not decode
        return failed_report(spark, f"unreadable: {str(error).splitlines()[0]}")
