"""Delimited text with a header line, every column as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from armorica import vocabulary as v


def separator_for(path: str) -> str:
    """Camp references are separated by commas, all other files by semicolons."""
    stem = v.REFERENCE_FILE.removesuffix(".csv").casefold()
    return "," if stem in path.rstrip("/").rpartition("/")[2].casefold() else ";"


def header_schema(header: str | None, sep: str = ";") -> StructType | None:
    """The columns of a header line, as text, so that Spark need not look for them; None if it has to.

    Quoted, missing and repeated names are left to Spark.
    """
    names = (header or "").split(sep)
    if '"' in (header or "") or "\\" in (header or "") or not all(name.strip() for name in names):
        return None
    if len({name.lower() for name in names}) < len(names):
        return None
    schema = StructType()
    for name in names:
        schema = schema.add(name, StringType())
    return schema


def read_delimited(
    spark: SparkSession, paths: str | Sequence[str], sep: str = ";", schema: str | StructType | None = None
) -> DataFrame:
    """Files that share one header, read in one scan; a file with another header fails."""
    reader = spark.read.option("header", "true").option("sep", sep).option("enforceSchema", "false")
    if schema:
        reader = reader.schema(schema)
    return reader.csv(paths if isinstance(paths, str) else list(paths))
