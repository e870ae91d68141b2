"""Finding, keeping and naming columns. Headers are matched without regard to case."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from armorica.functions.values import to_int, to_long


def column(name: str) -> Column:
    """Column of any name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def find_column(df: DataFrame, name: str) -> str | None:
    """The header of ``df`` equal to ``name`` but for case, if there is one."""
    wanted = name.casefold()
    return next((header for header in df.columns if header.casefold() == wanted), None)


def require_column(df: DataFrame, name: str) -> str:
    header = find_column(df, name)
    if header is None:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return header


def whole_number(df: DataFrame, name: str, wide: bool = False) -> Column:
    """The column read as a whole number; as it is if it already holds whole numbers.

    A column that is not touched can be compared in the scan.
    """
    header = require_column(df, name)
    if isinstance(df.schema[header].dataType, IntegralType):
        return column(header)
    return to_long(column(header)) if wide else to_int(column(header))


def keep_columns(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Only the wanted columns, in the order of ``df``; unknown names are ignored."""
    names = set(wanted)
    return df.select(*[column(header) for header in df.columns if header in names])


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[header.strip() for header in df.columns])


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """Headers in which the regular expression is found, in column order."""
    matcher = re.compile(pattern)
    return [header for header in df.columns if matcher.search(header)]


def year_columns(df: DataFrame) -> list[tuple[str, str, int]]:
    """(header, metric, year) for every header that ends in a four-digit year."""
    found = []
    for header in df.columns:
        match = re.search(r"^(.*?)\s*(\d{4})$", header, re.DOTALL)
        if match:
            found.append((header, match.group(1), int(match.group(2))))
    return found


def safe_names(keys: Iterable[str], prefix: str = "", taken: Iterable[str] = ()) -> dict[str, str]:
    """Column name for each key: lower case, other characters as ``_``.

    Keys are taken in sorted order. A name already in use, by an earlier key
    or by a column in ``taken``, gets the first free suffix ``_2``, ``_3``, ...
    """
    used = {name.casefold() for name in taken}
    names: dict[str, str] = {}
    for key in sorted(set(keys)):
        base = prefix + re.sub("[^a-z0-9]", "_", key.lower())
        name, turn = base, 1
        while name.casefold() in used:
            turn += 1
            name = f"{base}_{turn}"
        used.add(name.casefold())
        names[key] = name
    return names
