"""Named queries with their SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, each with SQL where DuckDB can express it. Times are UTC, so a query sets its session's zone to UTC."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"two queries are named {name}")

            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                    spark.conf.set("spark.sql.session.timeZone", "UTC")
                return fn(spark, sf_dir)

            self.queries[name] = run
            if sql:
                self.sql[name] = sql
            return fn

        return register


CORE = Registry()
