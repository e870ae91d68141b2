"""Dimension and fact tables as parquet in a shared folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession

from armorica import vocabulary as v
from armorica.operators.joins import BROADCAST_BYTES, measured_bytes, size_columns
from armorica.sinks.files import counted

FACT_SCHEMA = (
    f"`{v.COMMUNE_CODE}` string, `{v.COMMUNE_LABEL}` string, `{v.DEPARTMENT}` int, "
    f"`{v.DATA}` string, `{v.TYPE}` string, `{v.YEAR}` int"
)


SIZE_SCHEMA = "n bigint, bytes bigint"


def _size_path(path: str) -> str:
    # Spark leaves names with an underscore out of the table, and an overwrite removes them with it.
    return f"{path}/_size"


def write_table(df: DataFrame, path: str) -> int:
    """Replace a dimension table; gives the number of rows written.

    Rows and bytes are observed while writing and kept in the table's folder, for ``stored_bytes``.
    """
    seen = Observation("size")
    df.observe(seen, *size_columns(df)).write.mode("overwrite").parquet(path)
    size = seen.get
    kept = df.sparkSession.createDataFrame([(size["n"], size["bytes"])], SIZE_SCHEMA)
    kept.coalesce(1).write.mode("overwrite").json(_size_path(path))
    return size["n"]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a table when broadcast, as kept by ``write_table``; a table stored otherwise is measured."""
    try:
        kept = spark.read.schema(SIZE_SCHEMA).json(_size_path(path)).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = None
    return kept["bytes"] if kept else measured_bytes(spark.read.parquet(path))


def is_stored_small(spark: SparkSession, path: str, max_bytes: int = BROADCAST_BYTES) -> bool:
    return stored_bytes(spark, path) <= max_bytes


def ensure_table(df: DataFrame, path: str) -> None:
    """Create an empty table with the columns of ``df`` unless the table exists."""
    df.limit(0).write.mode("ignore").parquet(path)


def write_facts(df: DataFrame, path: str, mode: str = "replace") -> int:
    """Store facts by type and year; gives the number of rows written.

    With ``replace`` the (type, year) parts that ``df`` holds are replaced, all
    others stay, so that a repeated load does not double the facts. With
    ``append`` the rows are added to what is there. No shuffle: a metric file
    holds one type, so a task writes to few folders.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode is replace or append, not {mode}")
    df, seen = counted(df)
    writer = df.write.mode("append" if mode == "append" else "overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(v.TYPE, v.YEAR).parquet(path)
    return seen.get["n"]


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """All facts; a filter on type or year reads only the parts it needs."""
    try:
        facts = spark.read.schema(FACT_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], FACT_SCHEMA)
        raise
    return facts.select(v.COMMUNE_CODE, v.COMMUNE_LABEL, f"`{v.DEPARTMENT}`", v.YEAR, v.TYPE, v.DATA)
