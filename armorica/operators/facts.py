"""Dimensions, and metrics of any territory level brought onto communes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.functions import column, find_column, whole_number
from armorica.operators.cleaning import has_columns
from armorica.operators.reshape import pack_metrics

FACT_KEYS = (v.COMMUNE_CODE, v.COMMUNE_LABEL, v.DEPARTMENT, v.REGION, v.YEAR, v.TYPE)
FACT_COLUMNS = (v.COMMUNE_CODE, v.COMMUNE_LABEL, v.DEPARTMENT, v.YEAR, v.TYPE, v.DATA)
# The départements of the territory all lie in its one région; for geographies that do not name régions.
REGION_OF = {department: v.REGIONS[0] for department in v.DEPARTMENTS}

RegionOf = Mapping[int, int] | Column | DataFrame


def departments(geography: DataFrame) -> DataFrame:
    """Dimension (code_dep, nom_dep), one row per distinct pair."""
    return geography.select(
        whole_number(geography, v.DEPARTMENT).alias("code_dep"), column(v.GEO_DEPARTMENT_LABEL).alias("nom_dep")
    ).distinct()


def communes(geography: DataFrame) -> DataFrame:
    """Dimension (code_com, nom_com, geo_point, code_dep)."""
    return geography.select(
        column(v.COMMUNE_CODE).cast("string").alias("code_com"),
        column(v.GEO_COMMUNE_LABEL).alias("nom_com"),
        column(v.GEO_POINT).alias("geo_point"),
        whole_number(geography, v.DEPARTMENT).alias("code_dep"),
    )


def regions(geography: DataFrame) -> DataFrame | None:
    """Région of each département (code_dep, code_region), if the geography names régions."""
    header = find_column(geography, v.REGION)
    if header is None:
        return None
    pairs = geography.select(
        whole_number(geography, v.DEPARTMENT).alias("code_dep"), whole_number(geography, header).alias("code_region")
    )
    return pairs.filter("code_dep is not null and code_region is not null").distinct()


def join_communes(metrics: DataFrame, dimension: DataFrame, small: bool = False) -> DataFrame:
    """Rows of a commune with that commune; rows of unknown communes are dropped.

    ``small`` tells that the stored dimension has been measured and is within the
    broadcast bound; else Spark chooses, at the latest from what has been shuffled.
    """
    if small:
        dimension = F.broadcast(dimension)
    return metrics.join(dimension, column(v.COMMUNE_CODE) == F.col("code_com"), "inner")


def fan_out_departments(metrics: DataFrame, dimension: DataFrame) -> DataFrame:
    """Rows of a département repeated for each of its communes.

    No side is computed beforehand to be measured: Spark chooses the join, at
    the latest from what has been shuffled.
    """
    header = find_column(metrics, v.DEPARTMENT)
    metrics = metrics.withColumn("_department", whole_number(metrics, header))
    metrics = metrics.withColumnRenamed(header, v.DEPARTMENT)
    return dimension.join(metrics, F.col("code_dep") == F.col("_department"), "inner").drop("_department")


def replicate_regions(
    metrics: DataFrame, dimension: DataFrame, region_of: RegionOf = REGION_OF
) -> DataFrame:
    """Rows of a région repeated for each commune of that région.

    ``region_of`` gives the région of a commune: rows (code_dep, code_region)
    such as those of ``regions``, each pair once, a mapping from département
    codes, or a column of the dimension. An equi-join on the région. What finds no commune is told
    by ``regions_without_commune``.
    """
    header = find_column(metrics, v.REGION)
    metrics = metrics.withColumn("_region", whole_number(metrics, header)).withColumnRenamed(header, v.REGION)
    same = F.col("_commune_region") == F.col("_region")
    return _placed(dimension, region_of).join(metrics, same, "inner").drop("_region", "_commune_region")


def regions_without_commune(
    metrics: DataFrame, dimension: DataFrame, region_of: RegionOf = REGION_OF
) -> DataFrame:
    """Régions of the metrics, as ``code_region``, that no commune lies in, with their row count ``n``.

    A code that is no whole number is null here.
    """
    held = metrics.groupBy(whole_number(metrics, find_column(metrics, v.REGION)).alias("code_region"))
    known = _placed(dimension, region_of).select("_commune_region").distinct()
    counted = held.agg(F.count(F.lit(1)).alias("n"))
    return counted.join(known, F.col("code_region") == F.col("_commune_region"), "left_anti")


def _placed(dimension: DataFrame, region_of: RegionOf) -> DataFrame:
    """The communes with their région in ``_commune_region``."""
    if isinstance(region_of, DataFrame):
        pairs = region_of.select(
            F.col("code_dep").cast("int").alias("_dep"), F.col("code_region").cast("int").alias("_commune_region")
        )
        return dimension.join(pairs, F.col("code_dep") == F.col("_dep"), "left").drop("_dep")
    if not isinstance(region_of, Column):
        pairs = [F.lit(item) for pair in region_of.items() for item in pair]
        region_of = F.create_map(*pairs)[F.col("code_dep")]
    return dimension.withColumn("_commune_region", region_of.cast("int"))


def territory_level(metrics: DataFrame) -> str | None:
    """The finest territory code the metrics hold."""
    levels = (v.COMMUNE_CODE, v.DEPARTMENT, v.REGION)
    return next((level for level in levels if find_column(metrics, level)), None)


def join_dimension(
    metrics: DataFrame,
    dimension: DataFrame,
    region_of: RegionOf = REGION_OF,
    small: bool = False,
) -> DataFrame:
    """Bring metrics onto communes by the finest territory code they hold."""
    level = territory_level(metrics)
    if level == v.COMMUNE_CODE:
        return join_communes(metrics, dimension, small)
    if level == v.DEPARTMENT:
        return fan_out_departments(metrics, dimension)
    if level == v.REGION:
        return replicate_regions(metrics, dimension, region_of)
    raise ValueError(f"no territory code among {metrics.columns}")


def facts(
    metrics: DataFrame,
    dimension: DataFrame,
    region_of: RegionOf = REGION_OF,
    small: bool = False,
) -> DataFrame | None:
    """Fact rows of a metric table, all metrics packed as JSON.

    None for a table that lacks the year or the type. Rows without a year are
    kept, with a null year.
    """
    if not has_columns(metrics, v.YEAR, v.TYPE):
        return None
    packed = pack_metrics(join_dimension(metrics, dimension, region_of, small), FACT_KEYS)
    return packed.select(
        F.col("code_com").alias(v.COMMUNE_CODE),
        F.col("nom_com").alias(v.COMMUNE_LABEL),
        F.col("code_dep").alias(v.DEPARTMENT),
        whole_number(packed, v.YEAR).alias(v.YEAR),
        column(v.TYPE),
        column(v.DATA),
    )
