"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .tables import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``function(t)``, where ``t(table)`` gives a table or projection as a data frame."""

    def wrap(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from .tables import table

            return function(lambda n: table(spark, sf_dir, n))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = oracle(sql)
        return function

    return wrap


from . import files, labels, matching, relational, scores  # noqa: E402, F401
