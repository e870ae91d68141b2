"""Geography codes: one canonical form, and the filter to a territory."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame

from armorica import vocabulary as v
from armorica.functions import column, compose_commune, find_column, pad_code, pad_commune, whole_number
from armorica.functions.values import plain_code

log = logging.getLogger(__name__)


def normalise_geography(df: DataFrame) -> DataFrame:
    """Pad the geography codes and derive the ones that are missing.

    Département to 2 characters, commune number to 3, commune code to 5. A
    missing commune code is composed from the two parts; missing parts are cut
    out of the commune code. Codes of any header case get the standard name.
    """
    rules = {
        v.DEPARTMENT: lambda code: pad_code(code, 2),
        v.COMMUNE_PART: lambda code: pad_code(code, 3),
        v.COMMUNE_CODE: pad_commune,
    }
    name_of = {find_column(df, name): name for name in rules if find_column(df, name)}
    padded = df.select(
        *[
            rules[name_of[header]](column(header)).alias(name_of[header]) if header in name_of else column(header)
            for header in df.columns
        ]
    )
    present = set(name_of.values())
    commune = column(v.COMMUNE_CODE)
    derived: dict[str, Column] = {}
    if v.COMMUNE_CODE in present:
        derived = {v.DEPARTMENT: commune.substr(1, 2), v.COMMUNE_PART: commune.substr(3, 3)}
    elif {v.DEPARTMENT, v.COMMUNE_PART} <= present:
        derived = {v.COMMUNE_CODE: compose_commune(column(v.DEPARTMENT), column(v.COMMUNE_PART))}
    return padded.withColumns({name: code for name, code in derived.items() if name not in present})


def plain_codes(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Undo the padding of the named code columns; absent names are ignored."""
    headers = {find_column(df, name): name for name in names}
    return df.select(
        *[plain_code(column(h)).alias(headers[h]) if h in headers else column(h) for h in df.columns]
    )


def keep_territory(
    df: DataFrame,
    departments: Iterable[int] | DataFrame = v.DEPARTMENTS,
    regions: Iterable[int] | DataFrame = v.REGIONS,
) -> DataFrame:
    """Rows of the territory, by département, else by région, else all of them.

    The code column comes back in plain text form. Codes may be a list or, when
    there are many, a one-column DataFrame that is semi-joined.
    """
    for name, wanted in ((v.DEPARTMENT, departments), (v.REGION, regions)):
        if find_column(df, name):
            return plain_codes(keep_codes(df, name, wanted), [name])
    log.info("neither %r nor %r present, territory not filtered", v.DEPARTMENT, v.REGION)
    return df


def keep_codes(df: DataFrame, name: str, wanted: Iterable[int] | DataFrame) -> DataFrame:
    """Rows whose code, read as a whole number, is wanted."""
    code = whole_number(df, name)
    if not isinstance(wanted, DataFrame):
        return df.filter(code.isin(list(wanted)))
    codes = wanted.select(whole_number(wanted, wanted.columns[0]).alias("_wanted"))
    return df.join(codes, code == codes["_wanted"], "left_semi")
