"""Where queries are collected, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkstream.session import prepare
from sparkstream.tables import unzoned

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under its own name."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return unzoned(fn(prepare(spark), sf_dir))

        run.__doc__ = fn.__doc__
        run.__name__ = label = name or fn.__name__
        QUERIES[label] = run
        if sql is not None:
            ORACLES[label] = sql.strip()
        return fn

    return add
