"""A registry of queries with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import ship

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a query under ``name``, with the SQL that gives the same rows."""

        def add(f: Query) -> Query:
            if name in self.queries:
                raise KeyError(f"{name} is registered twice")

            @wraps(f)
            def run(spark: SparkSession, folder: str) -> DataFrame:
                ship(spark)
                return f(spark, folder)

            self.queries[name] = run
            if sql:
                self.sql[name] = sql
            return f

        return add
