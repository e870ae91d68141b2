"""Tables of a database reached over JDBC."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A table; with ``split`` (column, lowest, highest, parts) read in parallel.

    Filters and column choices on the result are sent to the database.
    """
    reader = spark.read.format("jdbc").options(**{"url": url, "dbtable": table, **(options or {})})
    if split:
        name, lowest, highest, parts = split
        reader = reader.options(
            partitionColumn=name, lowerBound=str(lowest), upperBound=str(highest), numPartitions=str(parts)
        )
    return reader.load()


MAX_BIGINT = (1 << 63) - 1


def quantile_predicates(sample: DataFrame, key: str, parts: int) -> list[str]:
    """Conditions on a whole-number key that split a table into parts of about equal rows.

    Split points are quantiles of the sample, so that gaps cost nothing; a key that is several
    quantiles is a part of its own. Every value, null included, meets exactly one condition; a sample
    without values, or with one, gives fewer parts.
    """
    if parts < 1:
        raise ValueError("at least one part")
    places = [place / parts for place in range(1, parts)]
    quantiles = F.percentile_approx(F.col(f"`{key}`").cast("bigint"), places, 10_000)
    found = Counter((sample.agg(quantiles).first()[0] or []) if places else [])
    splits = sorted({*found, *(split + 1 for split, n in found.items() if n > 1 and split < MAX_BIGINT)})
    if not splits:
        return ["1 = 1"]
    between = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(splits[:-1], splits[1:], strict=True)]
    return [f"{key} < {splits[0]} OR {key} IS NULL", *between, f"{key} >= {splits[-1]}"]


def read_database_evenly(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    parts: int,
    sample: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table read in parallel, split by ``quantile_predicates`` of a whole-number key.

    ``sample``: a query that gives a sample of the keys, as the database writes it; by default all keys
    are read, the key column alone.
    """
    keys = read_database(spark, url, f"({sample or f'SELECT {key} FROM {table}'}) sampled_keys", options)
    predicates = quantile_predicates(keys, key, parts)
    return spark.read.jdbc(url, table, predicates=predicates, properties=dict(options or {}))
