"""The table of named queries: what runs, and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Named queries with, where SQL can express them, an equivalent DuckDB text."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, oracle: str | None = None) -> Callable[[Query], Query]:
        def keep(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = fn
            if oracle is not None:
                self.oracles[name] = oracle
            return fn

        return keep


CORE = Registry()
query = CORE.query
