"""Queries over the driver tables, each with the SQL that must give the same rows.

A query takes (spark, folder) and returns a lazy DataFrame.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ("sources", "columns", "rows", "joins", "results", "series", "text", "pages", "jobs")


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL twin if there is one."""

    def register(query: Query) -> Query:
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"{__name__}.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
