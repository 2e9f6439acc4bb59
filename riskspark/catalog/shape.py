"""Small helpers that give query results and SQL results the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

DIGITS = 6


def rounded(df: DataFrame) -> DataFrame:
    """Every double rounded, every timestamp as text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            # + 0.0 turns -0.0 into 0.0
            c = F.round(c, DIGITS) + F.lit(0.0)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)
