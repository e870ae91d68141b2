"""Dimensions and facts: load from the output tree, check, export by type and year."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.concurrency import AT_ONCE, attempt_together, run_together
from armorica.functions import columns_like, require_column, year_columns
from armorica.operators import checks
from armorica.operators.cleaning import keep_slice
from armorica.operators.facts import (
    REGION_OF,
    RegionOf,
    communes,
    departments,
    facts,
    regions_without_commune,
    territory_level,
)
from armorica.operators.reshape import MOST_COLUMNS, flatten_metrics, is_malformed, keys_by, long_metrics, unpivot_years
from armorica.sinks import (
    append_database,
    is_stored_small,
    load_once,
    overwrite_database,
    read_facts,
    write_delimited,
    write_facts,
    write_table,
)
from armorica.sources import FileTree, file_tree
from armorica.sources.tree import FILE_PATH, Group, add_from_path, file_type, path_columns, read_labelled, with_provenance
from armorica.workspace import materialise

# Folder of the rows without a year in a file split by year.
NO_YEAR = "__HIVE_DEFAULT_PARTITION__"
METRIC_FILE = r"par-(commune|departement)\.csv"


def load_dimensions(geography: DataFrame, warehouse: str) -> dict[str, int]:
    """Write both dimension tables; gives their row counts."""
    tables = {v.DEPARTMENT_TABLE: departments(geography), v.COMMUNE_TABLE: communes(geography)}
    tasks = {name: partial(write_table, table, f"{warehouse}/{name}") for name, table in tables.items()}
    return run_together(geography.sparkSession, tasks, "dimension")


def load_facts(
    spark: SparkSession,
    outputs: str,
    warehouse: str,
    region_of: RegionOf = REGION_OF,
    mode: str = "replace",
    changed_only: bool = False,
) -> int:
    """Bring every metric file onto communes and store the facts in one write; gives the rows written.

    ``mode`` is that of ``write_facts``. Rows without a year are loaded without one.
    Régions without a commune are told by ``unplaced_regions``.

    A manifest beside the facts keeps path, length and time of the files that were loaded. With
    ``changed_only`` (and ``replace``) only types with a file that is new, changed or gone since are loaded, and
    replace their (type, year) parts; all types if the communes have been stored anew. A year
    that no file of a type holds any more stays. A load that fails leaves the manifest as it was.
    """
    if changed_only and mode != "replace":
        raise ValueError("changed files replace their parts, they cannot be appended")
    tree = _with_types(file_tree(spark, outputs))
    loaded = f"{warehouse}/{v.FACT_TABLE}_loaded"
    communes_at = f"{warehouse}/{v.COMMUNE_TABLE}"
    stored = spark.read.format("binaryFile").load(communes_at).selectExpr("path", "length", "modificationTime as modified")
    now = tree.listed.select("path", "length", "modified", v.TYPE).unionByName(stored.withColumn(v.TYPE, F.lit(None).cast("string")))
    chosen = _changed(spark, tree, now, loaded) if changed_only else tree
    tables = metric_tables(spark, outputs, chosen)
    written = 0
    if tables:
        dimension = spark.read.parquet(communes_at)
        small = is_stored_small(spark, communes_at)
        parts = [facts(table, dimension, region_of, small) for table in tables]
        parts = [part for part in parts if part is not None]
        if parts:
            written = write_facts(reduce(DataFrame.unionByName, parts), f"{warehouse}/{v.FACT_TABLE}", mode)
    now.write.mode("overwrite").parquet(loaded)
    return written


def _with_types(tree: FileTree) -> FileTree:
    """The tree with the type of each file."""
    return FileTree(path_columns(tree.listed, {v.TYPE: file_type}, "path"), tree.chosen)


def _changed(spark: SparkSession, tree: FileTree, now: DataFrame, loaded: str) -> FileTree:
    """Files of the types that differ from what was loaded."""
    try:
        before = spark.read.parquet(loaded)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return tree
    same = ["path", "length", "modified"]
    # What is there before or now, but not both.
    different = now.join(before, same, "left_anti").unionByName(before.join(now, same, "left_anti"))
    different = materialise(different.select(v.TYPE).distinct())
    if not different.filter(F.col(v.TYPE).isNull()).isEmpty():
        return tree
    listed = tree.listed.join(different.withColumn("_changed", F.lit(True)), v.TYPE, "left")
    return FileTree(listed, tree.chosen).where(F.col("_changed"))


def unplaced_regions(
    spark: SparkSession, outputs: str, warehouse: str, region_of: RegionOf = REGION_OF
) -> DataFrame:
    """Régions of the metric files that no commune lies in and that make no facts, with their row count ``n``."""
    dimension = spark.read.parquet(f"{warehouse}/{v.COMMUNE_TABLE}")
    lost = [
        regions_without_commune(table, dimension, region_of)
        for table in metric_tables(spark, outputs)
        if territory_level(table) == v.REGION
    ]
    if not lost:
        return spark.createDataFrame([], "code_region int, n bigint")
    return reduce(DataFrame.unionByName, lost).groupBy("code_region").agg(F.sum("n").alias("n"))


def metric_tables(spark: SparkSession, outputs: str, tree: FileTree | None = None) -> list[DataFrame]:
    """Metric files, of the whole folder or those chosen in its ``tree``, as tables with a type and a year, one per distinct header.

    Files in a year folder take the year from it. Département and région files
    with year columns give one row per year column. A département file can be
    both; one that is neither is left out.
    """
    name, year = F.lower("name"), F.substring_index("folder", "=", -1)
    is_metric = name.rlike(METRIC_FILE)
    # All headers are found in one job; a file can be of several kinds.
    kinds = {
        "dated": is_metric & year.rlike(r"^\d{4}$"),
        "undated": is_metric & (year == NO_YEAR),
        "region": name.rlike(r"par-region\.csv$"),
        "department": name.rlike(r"par-departement\.csv$"),
    }
    groups = read_labelled(spark, tree or file_tree(spark, outputs), kinds)
    tables = []
    for kind in kinds:
        for group in groups:
            if group.label != kind:
                continue
            years = year_columns(group.table)
            # Without a year folder it is one of the files below, if it has year columns.
            if kind == "dated" or kind == "undated" and not years:
                tables.append(with_provenance(group.table, group))
            elif kind == "region" and years and columns_like(group.table, r"(?i)%|pour mille"):
                tables.append(_long(group, [require_column(group.table, v.REGION), v.INDICATOR]))
            elif kind == "department" and years:
                tables.append(_long(group, [require_column(group.table, v.DEPARTMENT)]))
    return tables


def check_dimensions(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The violations of the constraints between the dimension tables, to be looked at before facts are loaded."""
    department = spark.read.parquet(f"{warehouse}/{v.DEPARTMENT_TABLE}")
    commune = spark.read.parquet(f"{warehouse}/{v.COMMUNE_TABLE}")
    return {
        "department key": checks.duplicate_keys(department, ["code_dep"]),
        "commune key": checks.duplicate_keys(commune, ["code_com"]),
        "commune in department": checks.orphan_keys(commune, "code_dep", department, "code_dep"),
    }


def check_warehouse(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The violations of each constraint on the stored tables; the facts are scanned once."""
    department = spark.read.parquet(f"{warehouse}/{v.DEPARTMENT_TABLE}")
    commune = spark.read.parquet(f"{warehouse}/{v.COMMUNE_TABLE}")
    fact = read_facts(spark, f"{warehouse}/{v.FACT_TABLE}")
    return check_dimensions(spark, warehouse) | check_facts(fact, commune, department)


def check_facts(fact: DataFrame, commune: DataFrame, department: DataFrame) -> dict[str, DataFrame]:
    """The violations of the constraints on facts.

    One scan counts the rows, and those that break a rule, of every commune, département and
    type; keys are looked up among what is left.
    """
    rules = {v.COMMUNE_CODE: checks.fits(v.COMMUNE_CODE, 5), v.DEPARTMENT: checks.is_int(v.DEPARTMENT)}
    malformed = is_malformed(v.DATA)
    reduced = materialise(checks.counted_by(fact, [v.COMMUNE_CODE, v.DEPARTMENT, v.TYPE], [*rules.values(), ~malformed]))
    broken = {name: F.sum(F.col("broken")[place]) for place, name in enumerate(rules)}
    of_type = reduced.filter(F.col("key") == v.TYPE)
    return {
        "fact in commune": checks.unknown_keys(reduced, v.COMMUNE_CODE, commune, "code_com"),
        "fact in department": checks.unknown_keys(reduced, v.DEPARTMENT, department, "code_dep"),
        "fact types": checks.broken_rules(of_type, broken),
        "fact data": of_type.filter(F.col("broken")[len(rules)] > 0).select(
            F.col("value").alias(v.TYPE), F.col("broken")[len(rules)].alias("n")
        ),
    }


def publish(
    spark: SparkSession, warehouse: str, url: str, options: Mapping[str, str] | None = None, run: str | None = None
) -> dict[str, int]:
    """Copy the stored tables to a database: dimensions replaced, facts added; rows written per table.

    With a ``run`` each table is loaded once for it (``sinks.load_once``), however often tasks or the whole are
    repeated; without, a repeated task or call adds its facts again.
    """
    dimensions = {v.DEPARTMENT_TABLE: v.DEPARTMENT_DDL, v.COMMUNE_TABLE: v.COMMUNE_DDL}
    if run is not None:
        once = {
            name: load_once(spark.read.parquet(f"{warehouse}/{name}"), url, name, run, True, ddl, options) for name, ddl in dimensions.items()
        }
        return once | {v.FACT_TABLE: load_once(read_facts(spark, f"{warehouse}/{v.FACT_TABLE}"), url, v.FACT_TABLE, run, options=options)}
    written = {
        name: overwrite_database(spark.read.parquet(f"{warehouse}/{name}"), url, name, ddl, options)
        for name, ddl in dimensions.items()
    }
    fact = read_facts(spark, f"{warehouse}/{v.FACT_TABLE}")
    return written | {v.FACT_TABLE: append_database(fact, url, v.FACT_TABLE, options)}


class ExportFailed(RuntimeError):
    """Types that could not be exported, with their errors; ``written`` has the rows of the others."""

    def __init__(self, failed: Mapping[str, Exception], written: Mapping[str, int]) -> None:
        self.failed, self.written = dict(failed), dict(written)
        super().__init__("; ".join(f"{kind}: {str(error).splitlines()[0]}" for kind, error in self.failed.items()))


def export_facts(
    spark: SparkSession, warehouse: str, target: str, at_once: int = AT_ONCE, most_columns: int = MOST_COLUMNS
) -> dict[str, int]:
    """Facts back as columns, ``<target>/<type>.csv/annee=<year>``; rows written per type.

    Two jobs count and find the keys of all types. A type of more than about ``most_columns`` keys
    is written as rows (``metric``, ``valeur``) instead of columns, which a warning tells. Types differ
    in their columns, so each has its own write; the table is laid out by type, so together they read it
    once. ``at_once`` writes run together, each in a scheduler pool and job group of its own. A type that
    fails stops no other: ``ExportFailed`` tells all that did, when the others are written.
    """
    fact = read_facts(spark, f"{warehouse}/{v.FACT_TABLE}")
    keys = keys_by(fact, v.TYPE, most=most_columns)

    def export(kind: str | None) -> int:
        rows, columns = keep_slice(fact, {v.TYPE: kind}), keys.get(kind, [])
        flat = long_metrics(rows) if columns is None else flatten_metrics(rows, keys=columns)
        return write_delimited(flat, f"{target}/{kind}.csv", partition_by=[v.YEAR])

    tasks = {kind: partial(export, kind) for (kind,) in fact.select(v.TYPE).distinct().collect()}
    written, failed = attempt_together(spark, tasks, "export", at_once)
    if failed:
        raise ExportFailed(failed, written)
    return written


def _long(group: Group, ids: list[str]) -> DataFrame:
    return add_from_path(unpivot_years(group.table, [*ids, FILE_PATH]), {v.TYPE: file_type}, group)
