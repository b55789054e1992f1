"""The table of this subpackage's queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function as a query; ``sql`` is the same query for DuckDB."""

    def register(run: Run) -> Run:
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
