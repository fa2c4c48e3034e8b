"""Registry of the queries that the entry point exposes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.session import tune
from millrace.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(tune(spark), folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function of the tables, named after itself, with its SQL equivalent."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if build.__name__ in QUERIES:
            raise ValueError(f"query registered twice: {build.__name__}")
        QUERIES[build.__name__] = Query(build.__name__, build, sql)
        return build

    return register
