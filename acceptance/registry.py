"""Registry of acceptance queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acceptance.views import Inputs, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Inputs`` under its name, with the SQL that must give the same rows."""

    def register(function: Callable[[Inputs], DataFrame]):
        key = name or function.__name__
        QUERIES[key] = lambda spark, folder: function(Inputs(spark, folder))
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return function

    return register
