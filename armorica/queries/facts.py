"""Dimensions, joins onto them, and fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.operators.facts import (
    communes,
    departments,
    fan_out_departments,
    join_communes,
    join_dimension,
    regions,
    regions_without_commune,
    replicate_regions,
)
from armorica.operators import facts as fact_operators
from armorica.queries.registry import query, table
from armorica.sinks import write_table
from armorica.workspace import materialise, new_folder


def geography(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as communes of their nation."""
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias(v.COMMUNE_CODE),
        F.col("c_name").alias(v.GEO_COMMUNE_LABEL),
        F.col("c_mktsegment").alias(v.GEO_POINT),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")).alias(v.DEPARTMENT),
        F.col("n_name").alias(v.GEO_DEPARTMENT_LABEL),
    )


COMMUNES_SQL = """
select cast(c_custkey as varchar) as code_com, c_name as nom_com, c_mktsegment as geo_point, c_nationkey as code_dep
from customer"""


@query(
    """
select distinct n_nationkey as code_dep, n_name as nom_dep from nation join customer on c_nationkey = n_nationkey"""
)
def dim_departement(spark: SparkSession, folder: str) -> DataFrame:
    return departments(geography(spark, folder))


@query(COMMUNES_SQL)
def dim_commune(spark: SparkSession, folder: str) -> DataFrame:
    return communes(geography(spark, folder))


def commune_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Users of events as communes, some of them unknown."""
    unknown = F.when(F.col("event_type") == "error", "X").otherwise("")
    return table(spark, folder, "events").select(
        F.concat(F.col("user_id").cast("string"), unknown).alias(v.COMMUNE_CODE), "event_id", "event_type"
    )


@query(
    f"""
select cast(user_id as varchar) as "CODGEO", event_id, event_type, code_com, nom_com, geo_point, code_dep
from events join ({COMMUNES_SQL}) on cast(user_id as varchar) = code_com where event_type <> 'error'"""
)
def join_commune(spark: SparkSession, folder: str) -> DataFrame:
    return join_communes(commune_metrics(spark, folder), communes(geography(spark, folder)))


def department_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per nation and year, computed once."""
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    year = F.year("o_orderdate").alias(v.YEAR)
    counted = placed.groupBy("c_nationkey", year).agg(F.count(F.lit(1)).alias("orders"))
    code = F.concat(F.col("c_nationkey").cast("string"), F.lit(".0"))
    return materialise(counted.select(code.alias("Code Département"), v.YEAR, "orders"))


DEPARTMENT_SQL = """
select c_nationkey as nation, cast(year(o_orderdate) as integer) as annee, count(*) as orders
from orders join customer on o_custkey = c_custkey group by all"""


@query(
    f"""
select code_com, nom_com, geo_point, code_dep, nation || '.0' as "Code département", annee, orders
from ({COMMUNES_SQL}) join ({DEPARTMENT_SQL}) on nation = code_dep"""
)
def fanout_departement(spark: SparkSession, folder: str) -> DataFrame:
    return fan_out_departments(department_metrics(spark, folder), communes(geography(spark, folder)))


def region_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per region and year, computed once."""
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation")
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    year = F.year("o_orderdate").alias(v.YEAR)
    counted = placed.groupBy("n_regionkey", year).agg(F.count(F.lit(1)).alias("orders"))
    return materialise(counted.select(F.col("n_regionkey").cast("string").alias(v.REGION), v.YEAR, "orders"))


def region_of(spark: SparkSession, folder: str) -> DataFrame:
    """Région of each département, as the nations tell."""
    path = new_folder(spark, "regions")
    nations = table(spark, folder, "nation").select(
        F.concat(F.col("n_nationkey").cast("string"), F.lit(".0")).alias(v.DEPARTMENT),
        F.col("n_regionkey").cast("string").alias(v.REGION),
    )
    write_table(regions(nations), path)
    return spark.read.parquet(path)


REGION_SQL = """
select n_regionkey, cast(year(o_orderdate) as integer) as annee, count(*) as orders
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all"""


@query(
    f"""
select code_com, nom_com, geo_point, code_dep, cast(r.n_regionkey as varchar) as "Code région", annee, orders
from ({COMMUNES_SQL}) join nation n on n.n_nationkey = code_dep join ({REGION_SQL}) r on r.n_regionkey = n.n_regionkey"""
)
def replicate_region(spark: SparkSession, folder: str) -> DataFrame:
    dimension = communes(geography(spark, folder))
    return replicate_regions(region_metrics(spark, folder), dimension, region_of(spark, folder))


@query(
    """
select r_regionkey + 3 as code_region, count(*) as n from region join orders on o_custkey % 5 = r_regionkey
where r_regionkey + 3 not in (select n_regionkey from nation join customer on c_nationkey = n_nationkey) group by all"""
)
def region_unplaced(spark: SparkSession, folder: str) -> DataFrame:
    """Région rows that meet no commune are counted, not lost without notice."""
    orders, areas = table(spark, folder, "orders"), table(spark, folder, "region")
    placed = orders.join(areas, F.col("o_custkey") % 5 == F.col("r_regionkey"))
    metrics = placed.select((F.col("r_regionkey") + 3).cast("string").alias(v.REGION), "o_orderkey")
    return regions_without_commune(metrics, communes(geography(spark, folder)), region_of(spark, folder))


@query(
    f"""
select code_com, code_dep, annee, orders, 'departement' as key
from ({COMMUNES_SQL}) join ({DEPARTMENT_SQL}) on nation = code_dep
union all
select code_com, code_dep, annee, orders, 'region' as key
from ({COMMUNES_SQL}) join nation n on n.n_nationkey = code_dep join ({REGION_SQL}) r on r.n_regionkey = n.n_regionkey
union all
select code_com, code_dep, null as annee, event_id as orders, 'commune' as key
from events join ({COMMUNES_SQL}) on cast(user_id as varchar) = code_com where event_type <> 'error'"""
)
def key_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    """The same operator joins by the finest code each table holds."""
    dimension = communes(geography(spark, folder))
    regions = region_of(spark, folder)
    tables = {
        "departement": department_metrics(spark, folder),
        "region": region_metrics(spark, folder),
        "commune": commune_metrics(spark, folder).select(
            v.COMMUNE_CODE, F.lit(None).cast("int").alias(v.YEAR), F.col("event_id").alias("orders")
        ),
    }
    joined = [
        join_dimension(metrics, dimension, regions).select(
            "code_com", "code_dep", v.YEAR, "orders", F.lit(kind).alias("key")
        )
        for kind, metrics in tables.items()
    ]
    return joined[0].unionByName(joined[1]).unionByName(joined[2])


FACT_SQL = f"""
select code_com as "CODGEO", nom_com as "LIBGEO", code_dep as "Code département",
  cast(year(o_orderdate) as integer) as annee, 'commandes' as type,
  cast(json_object('o_orderkey', o_orderkey, 'status', case when o_orderstatus <> 'P' then o_orderstatus end,
    'code_com', code_com, 'nom_com', nom_com, 'geo_point', geo_point, 'code_dep', code_dep) as varchar) as data
from orders join ({COMMUNES_SQL}) on cast(o_custkey as varchar) = code_com"""


def order_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias(v.COMMUNE_CODE),
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.year("o_orderdate").cast("string").alias(v.YEAR),
        F.lit("commandes").alias(v.TYPE),
    )


@query(FACT_SQL)
def fact_table(spark: SparkSession, folder: str) -> DataFrame:
    return fact_operators.facts(order_metrics(spark, folder), communes(geography(spark, folder)))
