"""Means, year pivots and diploma shares."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.functions import column, share, sum_columns, whole_number
from armorica.operators.cleaning import drop_empty


def mean_by_territory(
    df: DataFrame,
    keys: Sequence[str],
    metric: str,
    alias: str,
    number: str = "double",
    as_text: bool = False,
) -> DataFrame:
    """Mean of the metric per group, as a number or as text with two decimals.

    ``number`` is the type the metric is summed in; a decimal makes the result
    independent of the order in which partitions are added.
    """
    value = column(metric).try_cast(number)
    mean = F.try_divide(F.sum(value).cast("double"), F.count(value))
    if as_text:
        mean = F.format_number(mean, 2)
    return df.groupBy(*[column(key) for key in keys]).agg(mean.alias(alias))


def mean_by_commune(df: DataFrame, number: str = "double", as_text: bool = True) -> DataFrame:
    """Mean per commune of the metric the headers offer: poverty rate, else social index.

    The social index is averaged per year as well.
    """
    keys = [v.COMMUNE_CODE, v.COMMUNE_LABEL]
    if v.POVERTY_METRIC in df.columns:
        return mean_by_territory(df, keys, v.POVERTY_METRIC, v.POVERTY_MEAN, number, as_text)
    if v.SOCIAL_METRIC in df.columns:
        return mean_by_territory(df, [*keys, v.YEAR], v.SOCIAL_METRIC, v.SOCIAL_MEAN, number, as_text)
    raise ValueError(f"neither {v.POVERTY_METRIC!r} nor {v.SOCIAL_METRIC!r} among {df.columns}")


def pivot_years(
    df: DataFrame,
    keys: Sequence[str] = (v.REGION, v.INDICATOR, v.UNIT),
    value: str = v.RATE,
    years: Iterable[int] = v.YEARS,
    year: str = v.YEAR,
    number: str | None = None,
) -> DataFrame:
    """One column ``<value> <year>`` per year, the greatest value where there are several.

    Values that are text are compared as text unless ``number`` names a type.

    One aggregation with a condition per year: a single shuffle on the keys,
    combined before it.
    """
    cell = column(value).try_cast(number) if number else column(value)
    rows = df.select(
        *[column(key) for key in keys], whole_number(df, year).alias("_year"), cell.alias("_cell")
    )
    return rows.groupBy(*[column(key) for key in keys]).agg(
        *[F.max(F.when(F.col("_year") == wanted, F.col("_cell"))).alias(f"{value} {wanted}") for wanted in years]
    )


def diploma_shares(df: DataFrame, keep: Sequence[str] = (), overlap: bool = False) -> DataFrame:
    """Population and shares of university and lower diplomas, by age band.

    Count headers end in an age suffix and name their level (``_rec0`` to
    ``_rec6``) before it; levels 5 and 6 are university. With ``overlap`` the
    lower class takes in every header in which ``_rec0`` to ``_rec4`` is found,
    the age suffix included, as in files published before; university counts
    then enter the totals twice. Rows in which a count is missing are dropped.
    """
    keep = keep or (v.COMMUNE_CODE, v.DEPARTMENT, v.COMMUNE_PART, v.COMMUNE_LABEL)
    school, university = {}, {}
    for suffix in (v.YOUNG_SUFFIX, v.ADULT_SUFFIX):
        headers = [header for header in df.columns if header.endswith(suffix)]
        stems = {header: header if overlap else header.removesuffix(suffix) for header in headers}
        high = [header for header in headers if re.search("_rec[56]", stems[header])]
        low = [header for header in headers if re.search("_rec[0-4]", stems[header])]
        university[suffix] = _total(df, high)
        school[suffix] = _total(df, low if overlap else [header for header in low if header not in high])
    counts = df.select(
        *[column(name) for name in keep],
        school[v.YOUNG_SUFFIX].alias("_school_young"),
        school[v.ADULT_SUFFIX].alias("_school_adult"),
        university[v.YOUNG_SUFFIX].alias("_university_young"),
        university[v.ADULT_SUFFIX].alias("_university_adult"),
    )
    s_young, s_adult = F.col("_school_young"), F.col("_school_adult")
    u_young, u_adult = F.col("_university_young"), F.col("_university_adult")
    young, adult = s_young + u_young, s_adult + u_adult
    shares = counts.select(
        *[column(name) for name in keep],
        (young + adult).alias(v.POPULATION),
        share(u_young + u_adult, young + adult).alias(v.UNIVERSITY_SHARE),
        share(s_young + s_adult, young + adult).alias(v.SCHOOL_SHARE),
        share(u_young, young).alias(v.UNIVERSITY_SHARE_YOUNG),
        share(s_young, young).alias(v.SCHOOL_SHARE_YOUNG),
        share(u_adult, adult).alias(v.UNIVERSITY_SHARE_ADULT),
        share(s_adult, adult).alias(v.SCHOOL_SHARE_ADULT),
    )
    return drop_empty(shares, v.POPULATION)


def _total(df: DataFrame, headers: Iterable[str]) -> Column:
    return sum_columns((whole_number(df, header, wide=True) for header in headers), zero="0L")
