"""Geography codes, years, territory filters and column choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.functions import find_column, keep_columns, trim_headers
from armorica.operators.cleaning import keep_slice, keep_years, normalise_year
from armorica.operators.geography import keep_territory, normalise_geography, plain_codes
from armorica.queries.registry import query, table


def spelled_department(nation: str) -> Column:
    """A nation key as files spell it: ``3.0``, and ``2a`` for one that is no number."""
    return F.when(F.col(nation) == 20, "2a").otherwise(F.concat(F.col(nation).cast("string"), F.lit(".0")))


@query(
    """
select c_custkey,
  case when c_nationkey = 20 then '2A' else lpad(cast(c_nationkey as varchar), 2, '0') end as "Code département",
  lpad(cast(c_custkey % 1000 as varchar), 3, '0') as "Code de la commune",
  case when c_nationkey = 20 then '2A' else lpad(cast(c_nationkey as varchar), 2, '0') end
    || lpad(cast(c_custkey % 1000 as varchar), 3, '0') as "CODGEO"
from customer"""
)
def geo_compose(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        spelled_department("c_nationkey").alias("code DÉPARTEMENT"),
        (F.col("c_custkey") % 1000).alias(v.COMMUNE_PART),
    )
    return normalise_geography(rows)


@query(
    """
with codes as (select o_orderkey, lpad(cast(o_orderkey as varchar), 5, '0') as code from orders)
select o_orderkey, code as "CODGEO", substr(code, 1, 2) as "Code département",
  substr(code, 3, 3) as "Code de la commune"
from codes"""
)
def geo_decompose(spark: SparkSession, folder: str) -> DataFrame:
    code = F.concat(F.col("o_orderkey").cast("string"), F.lit(".0"))
    return normalise_geography(table(spark, folder, "orders").select("o_orderkey", code.alias(v.COMMUNE_CODE)))


@query(
    """
select l_orderkey, l_linenumber, cast(l_suppkey as varchar) as "Code département",
  cast(l_partkey as varchar) as "Code de la commune"
from lineitem"""
)
def geo_clean(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.lpad(F.col("l_suppkey").cast("string"), 8, "0").alias(v.DEPARTMENT),
        F.concat(F.col("l_partkey").cast("string"), F.lit(".0")).alias(v.COMMUNE_PART),
    )
    return plain_codes(rows, [v.DEPARTMENT, v.COMMUNE_PART, v.REGION])


YEAR_SQL = "cast(year(o_orderdate) as integer)"


@query(
    f"""
select o_orderkey, case when o_orderpriority <> '5-LOW' then {YEAR_SQL} end as annee from orders"""
)
def year_normalise(spark: SparkSession, folder: str) -> DataFrame:
    year = F.year("o_orderdate")
    text = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("en "), year.cast("string")))
        .when(F.col("o_orderstatus") == "P", year.cast("string"))
        .otherwise(F.concat_ws("-", year.cast("string"), (year + 1).cast("string")))
    )
    return normalise_year(table(spark, folder, "orders").select("o_orderkey", text.alias(v.YEAR)))


@query(
    f"""
select o_orderkey, {YEAR_SQL} as annee from orders where year(o_orderdate) in (1996, 1998, 2000)"""
)
def year_filter(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    rows = orders.select("o_orderkey", F.year("o_orderdate").cast("string").alias(v.YEAR))
    return keep_years(rows, (1996, 1998, 2000))


@query(
    """
select c_custkey, cast(c_nationkey as varchar) as "Code département"
from customer where c_nationkey in (3, 7, 11, 22, 24)"""
)
def territory_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select("c_custkey", spelled_department("c_nationkey").alias(v.DEPARTMENT))
    return keep_territory(normalise_geography(rows).drop(v.COMMUNE_PART), departments=(3, 7, 11, 22, 24))


@query(
    """
select o_orderkey, cast(o_custkey as varchar) as "Code département"
from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')"""
)
def territory_semi_join(spark: SparkSession, folder: str) -> DataFrame:
    """A long list of codes, given as a DataFrame."""
    wanted = table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    rows = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias(v.DEPARTMENT))
    return keep_territory(rows, departments=wanted)


@query(
    """
select c_custkey, cast(n_regionkey as varchar) as "Code région"
from customer join nation on c_nationkey = n_nationkey where n_regionkey in (1, 3)"""
)
def region_fallback(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation")
    customers = table(spark, folder, "customer")
    located = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = located.select("c_custkey", F.col("n_regionkey").alias(v.REGION))
    return keep_territory(rows, regions=(1, 3))


@query("select c_custkey, c_name from customer")
def territory_unfiltered(spark: SparkSession, folder: str) -> DataFrame:
    """Neither code present: all rows stay."""
    return keep_territory(table(spark, folder, "customer").select("c_custkey", "c_name"))


@query("select p_partkey, p_brand, p_size from part")
def keep_only(spark: SparkSession, folder: str) -> DataFrame:
    return keep_columns(table(spark, folder, "part"), {"p_size", "p_partkey", "p_brand", "p_missing"})


@query("select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def header_trim(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    return trim_headers(parts.toDF(*[f" {name}\t" for name in parts.columns]))


@query("select p_partkey as code, p_brand as orientation from part")
def header_find(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("CODE"), F.col("p_brand").alias("Orientation")
    )
    return parts.select(
        F.col(find_column(parts, "Code")).alias("code"), F.col(find_column(parts, "ORIENTATION")).alias("orientation")
    )


@query(
    f"""
select o_orderkey, {YEAR_SQL} as annee, o_orderstatus as type from orders
where year(o_orderdate) = 1997 and o_orderstatus = 'F'"""
)
def slice_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias(v.YEAR), F.col("o_orderstatus").alias(v.TYPE)
    )
    return keep_slice(rows, {v.YEAR: 1997, v.TYPE: "F"})
