"""Years, schema gates and empty results."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from armorica import vocabulary as v
from armorica.functions import column, find_column, first_year, whole_number
from armorica.operators.geography import keep_codes

log = logging.getLogger(__name__)


def normalise_year(df: DataFrame, name: str = v.YEAR) -> DataFrame:
    """Year column as a whole number, ``2019-2020`` being 2019; without one, ``df``."""
    header = find_column(df, name)
    if header is None:
        log.info("no column %r, year not normalised", name)
        return df
    return df.withColumn(header, first_year(column(header)))


def keep_years(df: DataFrame, years: Iterable[int] = v.YEARS, name: str = v.YEAR) -> DataFrame:
    """Rows of the wanted years, the year as a whole number; without a year column, ``df``."""
    header = find_column(df, name)
    if header is None:
        log.info("no column %r, years not filtered", name)
        return df
    return keep_codes(df, header, years).withColumn(header, whole_number(df, header))


def keep_slice(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows equal to every given value, such as ``{"annee": 2017, "type": "loyer"}``; None is null."""
    for name, value in values.items():
        df = df.filter(column(name).isNull() if value is None else column(name) == value)
    return df


def drop_empty(df: DataFrame, name: str) -> DataFrame:
    """Rows in which the column has a value."""
    return df.filter(column(name).isNotNull())


def empty(df: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return df.limit(0)


def has_columns(df: DataFrame, *names: str) -> bool:
    """Whether every named column is there, exactly as spelled."""
    return set(names) <= set(df.columns)
