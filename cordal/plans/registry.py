"""Registration of a query together with its independent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Collects queries by function name; ``sql`` is what DuckDB runs beside it."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(function: Query) -> Query:
            self.queries[function.__name__] = function
            if sql is not None:
                self.sql[function.__name__] = sql
            return function

        return add
