"""Column-level building blocks; all of them stay inside Spark's code generation."""

from armorica.functions.columns import (
    column,
    columns_like,
    find_column,
    keep_columns,
    require_column,
    safe_names,
    trim_headers,
    whole_number,
    year_columns,
)
from armorica.functions.values import (
    compose_commune,
    first_year,
    pad_code,
    pad_commune,
    percent,
    remainder,
    share,
    sum_columns,
    to_int,
    to_long,
)

__all__ = [
    "column",
    "columns_like",
    "compose_commune",
    "find_column",
    "first_year",
    "keep_columns",
    "pad_code",
    "pad_commune",
    "percent",
    "remainder",
    "require_column",
    "safe_names",
    "share",
    "sum_columns",
    "to_int",
    "to_long",
    "trim_headers",
    "whole_number",
    "year_columns",
]
