"""Collects queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from boxloom.session import ship_packages
from checks.views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, python: bool = False):
    """Register a query; ``sql`` may use the derived views by name.

    ``python`` marks queries whose tasks run Python code of this repository.
    """

    def register(fn: Query) -> Query:
        @wraps(fn)
        def shipped(spark: SparkSession, sf: str) -> DataFrame:
            ship_packages(spark, str(Path(__file__).parent))
            return fn(spark, sf)

        QUERIES[name] = shipped if python else fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register
