"""Registration of queries, and the stand-ins the test tables offer for territory data.

Commune is a customer, order or supplier; département is a nation; région is a
region; the year is that of an order or shipment.
"""

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
    """Register a function under its own name, next to SQL with the same result."""

    def register(run: Run) -> Run:
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
