"""File trees converted to delimited files with canonical geography codes."""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.concurrency import run_together
from armorica.operators.geography import keep_territory, normalise_geography
from armorica.sinks import write_delimited
from armorica.sources import FileTree, file_tree
from armorica.sources.tree import add_from_path, file_year_folder, output_name, read_labelled

FILE = "source_file"
FOLDER = "year_folder"


def convert_yearly(
    spark: SparkSession,
    source: str,
    target: str,
    datasets: Iterable[str] = v.YEARLY_DATASETS,
    departments: Iterable[int] | DataFrame = v.DEPARTMENTS,
) -> int:
    """Datasets laid out by year, kept to the territory and mirrored; gives the number of rows written."""

    def convert(dataset: str) -> int:
        return _write(yearly_tables(spark, f"{source}/{dataset}", departments), f"{target}/{dataset}")

    # Datasets share no file.
    return sum(run_together(spark, {dataset: partial(convert, dataset) for dataset in datasets}, "convert").values())


def convert_tree(spark: SparkSession, source: str, target: str) -> int:
    """Every workbook of a tree, mirrored, no row left out; gives the number of rows written."""
    books = file_tree(spark, source).one_level().where(F.col("suffix") == ".xlsx")
    return _write(converted(spark, books, source), target)


def yearly_tables(
    spark: SparkSession, source: str, departments: Iterable[int] | DataFrame = v.DEPARTMENTS
) -> list[DataFrame]:
    """The files of each year folder, kept to the territory, one DataFrame per header."""
    files = file_tree(spark, source).one_level_of_each()
    return [keep_territory(table, departments) for table in converted(spark, files, source)]


def converted(spark: SparkSession, files: FileTree, base: str) -> list[DataFrame]:
    """Files with canonical codes, their path below ``base`` and their year folder, one DataFrame per header."""
    rules = {FILE: output_name(base), FOLDER: file_year_folder}
    groups = read_labelled(spark, files, {"": F.lit(True)})
    return [add_from_path(normalise_geography(group.table), rules, group) for group in groups]


def _write(tables: Iterable[DataFrame], target: str) -> int:
    written = 0
    for turn, table in enumerate(tables):
        # Rows still lie by source file, so a task meets few output files.
        mode = "append" if turn else "overwrite"
        written += write_delimited(table, target, partition_by=[FILE, FOLDER], mode=mode)
    return written
