"""Small driver-side tables as literal relations."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A few rows as a literal relation: no job to build it, and its size is known to Spark."""
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrays = [pa.array(values, type=f.type) for values, f in zip(columns, schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, made longer until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
