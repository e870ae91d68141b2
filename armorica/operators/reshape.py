"""Wide to long by year, and metrics packed into or read from JSON."""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.functions import column, safe_names, year_columns

log = logging.getLogger(__name__)

# JSON keys that become columns; more of them stay rows.
MOST_COLUMNS = 5_000


def unpivot_years(
    df: DataFrame,
    ids: Sequence[str],
    metric: str = "typeMetric",
    year: str = v.YEAR,
    value: str = "valeur",
    value_type: str = "string",
) -> DataFrame:
    """One row per year column: its metric name, its year, its value. Nulls are kept."""
    cells = [
        F.struct(
            F.lit(name).alias(metric),
            F.lit(number).alias(year),
            column(header).cast(value_type).alias(value),
        )
        for header, name, number in year_columns(df)
    ]
    if not cells:
        raise ValueError(f"no header ends in a year: {df.columns}")
    return df.select(*[column(name) for name in ids], F.inline(F.array(*cells)))


def pack_metrics(df: DataFrame, keys: Iterable[str], data: str = v.DATA) -> DataFrame:
    """All columns that are no keys as one JSON text, null metrics included."""
    keys = set(keys)
    metrics = [column(name) for name in df.columns if name not in keys]
    if not metrics:
        return df.withColumn(data, F.lit("{}"))
    return df.withColumn(data, F.to_json(F.struct(*metrics), {"ignoreNullFields": "false"}))


def metric_keys_of(df: DataFrame, data: str = v.DATA, by: Sequence[str] = ()) -> DataFrame:
    """JSON keys of each row, next to the ``by`` columns."""
    return df.select(*[column(name) for name in by], F.explode(F.json_object_keys(column(data))).alias("key"))


def metric_keys(df: DataFrame, data: str = v.DATA, by: Sequence[str] = ()) -> DataFrame:
    """Distinct JSON keys, per group of the ``by`` columns if there are any."""
    return metric_keys_of(df, data, by).distinct()


def key_numbers(df: DataFrame, by: str, data: str = v.DATA) -> DataFrame:
    """Rows (group, keys): about how many distinct JSON keys each group has.

    From mergeable sketches of some kilobytes, whatever the number of keys; about 2 % off.
    """
    held = metric_keys_of(df, data, [by]).select(column(by).alias("group"), "key")
    return held.groupBy("group").agg(F.hll_sketch_estimate(F.hll_sketch_agg("key")).alias("keys"))


def keys_by(df: DataFrame, by: str, data: str = v.DATA, most: int = MOST_COLUMNS) -> dict[object, list[str] | None]:
    """The JSON keys of each group, sorted, each of which is to become a column.

    None for a group of more than about ``most`` keys: those are not collected, their rows
    are for ``long_metrics``. Groups without keys are not given.
    """
    groups: dict[object, list[str] | None] = {}
    crowded = [row["group"] for row in key_numbers(df, by, data).filter(F.col("keys") > most).collect()]
    for group in crowded:
        log.warning("%s has more than about %d keys: a row per key", group, most)
        groups[group] = None
    if crowded:
        known = [group for group in crowded if group is not None]
        among = F.coalesce(column(by).isin(known), F.lit(False)) if known else F.lit(False)
        df = df.filter(~(among | column(by).isNull()) if None in crowded else ~among)
    found: dict[object, list[str]] = defaultdict(list)
    for row in metric_keys(df, data, [by]).select(column(by).alias("group"), "key").collect():
        found[row["group"]].append(row["key"])
    return groups | {group: sorted(keys) for group, keys in found.items()}


def flatten_metrics(
    df: DataFrame, data: str = v.DATA, prefix: str = "", keys: Iterable[str] | None = None, most: int = MOST_COLUMNS
) -> DataFrame:
    """One text column per JSON key, in sorted order, in place of the JSON.

    Without ``keys`` they are looked up first; more than about ``most`` are refused before
    any is collected, as ``long_metrics`` has a row per key instead. Malformed JSON gives nulls.
    """
    if keys is None:
        number = metric_keys_of(df, data).agg(F.hll_sketch_estimate(F.hll_sketch_agg("key"))).first()[0] or 0
        if number > most:
            raise ValueError(f"about {number} keys are too many for columns, long_metrics has a row for each")
        keys = [row["key"] for row in metric_keys(df, data).collect()]
    keys = sorted(set(keys))
    kept = [name for name in df.columns if name != data]
    names = safe_names(keys, prefix, taken=kept)
    parsed = df.withColumn("_metrics", F.from_json(column(data), "map<string,string>"))
    cells = [F.col("_metrics").getItem(key).alias(name) for key, name in names.items()]
    return parsed.select(*[column(name) for name in kept], *cells)


def long_metrics(df: DataFrame, data: str = v.DATA, key: str = "metric", value: str = "valeur") -> DataFrame:
    """One row per JSON key and its value as text, in place of the JSON; no keys, no rows."""
    kept = [column(name) for name in df.columns if name != data]
    return df.select(*kept, F.explode(F.from_json(column(data), "map<string,string>")).alias(key, value))


def is_malformed(data: str = v.DATA) -> Column:
    """Whether a text is there but is no JSON object; never null."""
    return column(data).isNotNull() & F.json_object_keys(column(data)).isNull()


def malformed_json(df: DataFrame, data: str = v.DATA) -> DataFrame:
    """Rows whose text is there but is no JSON object."""
    return df.filter(is_malformed(data))
