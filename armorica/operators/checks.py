"""Constraint checks: each gives the violations, so an empty result means sound data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armorica.functions import column


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are null or held by several rows, with their row count ``n``."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | column(key).isNull()
    counted = df.groupBy(*[column(key) for key in keys]).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") > 1) | missing)


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null keys of ``child`` that ``parent`` lacks, with their row count ``n``.

    The child is reduced to one row per key before the join, so that a key
    with many rows weighs no more than any other.
    """
    held = child.filter(column(key).isNotNull()).groupBy(column(key)).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(column(parent_key).alias("_parent"))
    return held.join(known, column(key) == F.col("_parent"), "left_anti")


def counted_by(df: DataFrame, keys: Sequence[str], rules: Sequence[Column]) -> DataFrame:
    """Rows (key, value, n, broken): of each value of each key, as text, its rows and how many break each rule.

    Grouping sets over one scan: each key is a set, reduced before the shuffle, so that a
    value with many rows weighs no more than any other.
    """
    places = [f"_{place}" for place in range(len(keys))]
    flags = [f"_rule{place}" for place in range(len(rules))]
    source = df.select(
        *[column(key).cast("string").alias(place) for key, place in zip(keys, places, strict=True)],
        *[F.when(F.coalesce(rule, F.lit(False)), 0).otherwise(1).cast("bigint").alias(flag) for rule, flag in zip(rules, flags, strict=True)],
    )
    grouped = source.groupingSets([[F.col(place)] for place in places], *[F.col(place) for place in places]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("n"), *[F.sum(flag).alias(flag) for flag in flags]
    )
    # In the set of a key only its own bit is not set.
    every = (1 << len(keys)) - 1
    sets = {key: every & ~(1 << (len(keys) - 1 - place)) for place, key in enumerate(keys)}
    key, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, place in zip(keys, places, strict=True):
        is_set = F.col("_set") == sets[name]
        key, value = F.when(is_set, F.lit(name)).otherwise(key), F.when(is_set, F.col(place)).otherwise(value)
    return grouped.select(key.alias("key"), value.alias("value"), "n", F.array(*flags).alias("broken"))


def unknown_keys(counted: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``orphan_keys`` from the rows of ``counted_by``, the values in the type of the parent's key."""
    kind = parent.select(column(parent_key)).schema[0].dataType
    held = counted.filter((F.col("key") == key) & F.col("value").isNotNull())
    held = held.select(F.col("value").try_cast(kind).alias(key), "value", "n")
    known = parent.select(column(parent_key).alias("_parent"))
    return held.join(known, F.col("value") == F.col("_parent").cast("string"), "left_anti").select(column(key), "n")


def broken_rules(df: DataFrame, broken: Mapping[str, Column]) -> DataFrame:
    """(rule, n) of the aggregates that are above zero."""
    counts = df.agg(*[F.coalesce(total, F.lit(0)).cast("bigint").alias(f"_{i}") for i, total in enumerate(broken.values())])
    rows = [F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("n")) for i, name in enumerate(broken)]
    return counts.select(F.inline(F.array(*rows))).filter(F.col("n") > 0)


def is_int(name: str) -> Column:
    """Not null and a whole number in the range of an INT column."""
    text = column(name).cast("string")
    number = F.when(text.rlike(r"^\s*[+-]?0*\d{1,18}\s*$"), F.trim(text).cast("bigint"))
    return F.coalesce(number.between(-(2**31), 2**31 - 1), F.lit(False))


def fits(name: str, length: int) -> Column:
    """Not null and at most ``length`` characters."""
    return column(name).isNotNull() & (F.length(column(name).cast("string")) <= length)


def type_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, n): how many rows break each rule, in one pass over ``df``."""
    return broken_rules(df, {name: F.sum(F.when(F.coalesce(rule, F.lit(False)), 0).otherwise(1)) for name, rule in rules.items()})
