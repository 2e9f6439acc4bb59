"""All registered queries: name -> (Spark callable, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskspark.catalog import (
    drift, exploration, features, metrics, modelling, monitoring, selection, splitting, storage, streams,
    validation,
)

Query = Callable[[SparkSession, str], DataFrame]
FAMILIES = (validation, features, exploration, splitting, metrics, selection, drift, monitoring,
            streams, modelling, storage)


def _all() -> dict[str, tuple[Query, str | None]]:
    found: dict[str, tuple[Query, str | None]] = {}
    for family in FAMILIES:
        for name, entry in family.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = entry
    return found


def all_queries() -> dict[str, Query]:
    return {name: run for name, (run, _) in _all().items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
