"""Every operator and job as a query on the test tables, with the same result as plain SQL."""

from loadstone.catalog.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
