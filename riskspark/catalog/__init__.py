"""Named runs of every operator over the given tables, with the SQL each must match."""

from riskspark.catalog.registry import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
