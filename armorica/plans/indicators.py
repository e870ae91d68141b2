"""Indicators from one file each: poverty, diplomas, crime, social index.

Each plan gives the number of rows it wrote, or None if its input is missing.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from armorica import vocabulary as v
from armorica.operators.cleaning import keep_years, normalise_year
from armorica.operators.geography import keep_territory, normalise_geography
from armorica.operators.statistics import diploma_shares, mean_by_commune, pivot_years
from armorica.sinks import write_delimited
from armorica.sources import read_file

log = logging.getLogger(__name__)


def average_poverty(
    spark: SparkSession, source: str, target: str, departments: Iterable[int] = v.DEPARTMENTS
) -> int | None:
    """Mean poverty rate per commune."""
    table = _territory(spark, source, departments)
    return None if table is None else write_delimited(mean_by_commune(table), target)


def share_diplomas(
    spark: SparkSession,
    source: str,
    target: str,
    departments: Iterable[int] = v.DEPARTMENTS,
    overlap: bool = False,
) -> int | None:
    """Diploma shares per commune."""
    table = _territory(spark, source, departments)
    return None if table is None else write_delimited(diploma_shares(table, overlap=overlap), target)


def pivot_crime(
    spark: SparkSession,
    source: str,
    target: str,
    regions: Iterable[int] = v.REGIONS,
    years: Sequence[int] = v.YEARS,
) -> int | None:
    """Crime rates per indicator, one column per year."""
    table = _territory(spark, source, regions=regions)
    if table is None:
        return None
    return write_delimited(pivot_years(keep_years(table, years), years=years, number="double"), target)


def average_social_index(
    spark: SparkSession, source: str, target: str, departments: Iterable[int] = v.DEPARTMENTS
) -> int | None:
    """Mean social index per commune and year, one folder per year."""
    table = _territory(spark, source, departments)
    if table is None:
        return None
    return write_delimited(mean_by_commune(normalise_year(table)), target, partition_by=[v.YEAR], compact=True)


def _territory(
    spark: SparkSession,
    source: str,
    departments: Iterable[int] = v.DEPARTMENTS,
    regions: Iterable[int] = v.REGIONS,
) -> DataFrame | None:
    table = read_file(spark, source)
    if table is None:
        log.info("no input at %s, skipped", source)
        return None
    return keep_territory(normalise_geography(table), departments, regions)
