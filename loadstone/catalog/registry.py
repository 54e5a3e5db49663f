"""Registry of the catalogue: name -> (callable, SQL)."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


class Tables:
    """The tables of one scale folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register a function of Tables under its name, with the SQL that gives the same rows."""

    def register(function: Callable[[Tables], DataFrame]):
        key = name or function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(spark, folder))

        run.__name__, run.__doc__ = key, function.__doc__
        add(key, run, sql)
        return function

    return register


def add(key: str, run: Query, sql: str | None) -> None:
    if key in _queries:
        raise ValueError(f"query {key} is registered twice")
    _queries[key] = run
    if sql is not None:
        _sql[key] = sql


def _load() -> None:
    for module in ("capture", "writes", "joining", "grouping", "ordering", "scalars", "jobs"):
        import_module(f"loadstone.catalog.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
