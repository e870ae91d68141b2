"""Joins onto lookups and dimensions.

A side is broadcast only after its bytes have been counted: of a stored table when it was
written, else by an aggregate. Beyond the bound the join is left to Spark: a shuffled join
whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armorica.functions import column

BROADCAST_BYTES = 64 * 1024 * 1024
# Room for one row in a hashed relation besides its text.
ROW_BYTES = 16
CELL_BYTES = 8


def size_columns(df: DataFrame) -> list[Column]:
    """Aggregates of all rows: their number ``n`` and their ``bytes`` when broadcast."""
    text = F.concat_ws("", *[column(name).cast("string") for name in df.columns])
    octets = F.coalesce(F.sum(F.octet_length(text).cast("bigint")), F.lit(0))
    per_row = ROW_BYTES + CELL_BYTES * len(df.columns)
    return [F.count(F.lit(1)).alias("n"), (octets + F.count(F.lit(1)) * per_row).alias("bytes")]


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows, by one distributed aggregate."""
    return df.agg(*size_columns(df)).first()["bytes"]


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it is within the bound, else unchanged."""
    return F.broadcast(df) if is_small(df, max_bytes) else df
