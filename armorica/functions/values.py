"""Expressions on single values. Bad input gives null, under ANSI mode too."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(value: Column) -> Column:
    """Whole number of a code written ``22``, ``22.0`` or ``22.7``; null if it is none."""
    return _whole(value, "int")


def to_long(value: Column) -> Column:
    """The same for counts beyond the range of an int."""
    return _whole(value, "bigint")


def _whole(value: Column, number: str) -> Column:
    # By way of a decimal: the direct cast of 22.0 fails, at the price of an
    # exception per row, and a double would also read 2D as a number.
    return value.try_cast("decimal(38,6)").try_cast(number)


def pad_code(value: Column, width: int) -> Column:
    """Code with leading zeros; longer numbers are cut to ``width``.

    Codes that are no numbers (``2a``) are kept, in upper case.
    """
    return F.coalesce(F.lpad(to_int(value).cast("string"), width, "0"), _text(value))


def plain_code(value: Column) -> Column:
    """The code without padding or decimals: ``01`` and ``1.0`` both give ``1``."""
    return F.coalesce(to_int(value).cast("string"), _text(value))


def _text(value: Column) -> Column:
    return F.upper(F.trim(value.cast("string")))


def pad_commune(value: Column) -> Column:
    """Five-character commune code, without the ``.0`` a workbook may add."""
    return F.lpad(F.regexp_replace(value.cast("string"), r"\.0$", ""), 5, "0")


def compose_commune(department: Column, commune: Column) -> Column:
    """Commune code made of a padded département and a padded commune number."""
    return F.concat(department, commune)


def first_year(value: Column) -> Column:
    """Leading four-digit year, so ``2019-2020`` is 2019; null without one."""
    return F.nullif(F.regexp_extract(value.cast("string"), r"^(\d{4})", 1), F.lit("")).cast("int")


def percent(value: Column, number: str = "double") -> Column:
    """Number of a percentage written ``12,34%``."""
    return F.translate(value.cast("string"), ",%", ".").try_cast(number)


def sum_columns(values: Iterable[Column], zero: str = "0") -> Column:
    """Row-wise sum; null as soon as one value is."""
    return reduce(add, values, F.expr(zero))


def remainder(total: float, *parts: Column) -> Column:
    """What the parts leave of ``total``, never below zero; null stays null."""
    left = reduce(lambda rest, part: rest - part, parts, F.lit(total))
    return F.when(left < 0, F.lit(0)).otherwise(left)


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` in percent of ``whole``, rounded half up; null for a zero whole."""
    exact = F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)"))
    return F.round(exact, digits).cast("double")
