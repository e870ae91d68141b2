"""Means, year pivots and diploma shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.operators import statistics
from armorica.operators.cleaning import drop_empty
from armorica.operators.statistics import diploma_shares, mean_by_commune, pivot_years
from armorica.queries.registry import query, table

MONEY = "decimal(12,2)"
MEAN_SQL = "cast(sum(cast({0} as decimal(12,2))) as double) / count({0})"


def orders_by_commune(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


@query(
    f"""
select c_nationkey, c_mktsegment, {MEAN_SQL.format("c_acctbal")} as mean from customer group by all"""
)
def mean_by_territory(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    return statistics.mean_by_territory(customers, ["c_nationkey", "c_mktsegment"], "c_acctbal", "mean", MONEY)


@query(
    f"""
select cast(c_custkey as varchar) as "CODGEO", c_name as "LIBGEO",
  format('{{:,.2f}}', {MEAN_SQL.format("o_totalprice")}) as taux_pauvrete_commune
from orders join customer on o_custkey = c_custkey group by all"""
)
def mean_poverty(spark: SparkSession, folder: str) -> DataFrame:
    rows = orders_by_commune(spark, folder).select(
        F.col("c_custkey").cast("string").alias(v.COMMUNE_CODE),
        F.col("c_name").alias(v.COMMUNE_LABEL),
        F.col("o_totalprice").alias(v.POVERTY_METRIC),
    )
    return mean_by_commune(rows, MONEY)


@query(
    f"""
select cast(c_custkey as varchar) as "CODGEO", c_name as "LIBGEO", cast(year(o_orderdate) as integer) as annee,
  {MEAN_SQL.format("o_totalprice")} as indice_position_sociale
from orders join customer on o_custkey = c_custkey group by all"""
)
def mean_by_territory_year(spark: SparkSession, folder: str) -> DataFrame:
    rows = orders_by_commune(spark, folder).select(
        F.col("c_custkey").cast("string").alias(v.COMMUNE_CODE),
        F.col("c_name").alias(v.COMMUNE_LABEL),
        F.year("o_orderdate").alias(v.YEAR),
        F.col("o_totalprice").alias(v.SOCIAL_METRIC),
    )
    return mean_by_commune(rows, MONEY, as_text=False)


PIVOT_YEARS = (1996, 1998, 2000)
PIVOT_SQL = "select l_partkey, l_returnflag, " + ", ".join(
    f'max(case when year(l_shipdate) = {year} then l_extendedprice end) as "price {year}"' for year in PIVOT_YEARS
)


def prices_by_year(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_partkey", "l_returnflag", F.year("l_shipdate").alias(v.YEAR), F.col("l_extendedprice").alias("price")
    )
    return pivot_years(rows, ["l_partkey", "l_returnflag"], "price", PIVOT_YEARS)


@query(PIVOT_SQL + " from lineitem group by l_partkey, l_returnflag")
def pivot_year(spark: SparkSession, folder: str) -> DataFrame:
    return prices_by_year(spark, folder)


def diploma_counts(spark: SparkSession, folder: str, key: str, absent: int | None) -> DataFrame:
    """Lines per key, level (line number less one) and age band (line status)."""
    cells = []
    for level in range(7):
        for band, status in ((1, "F"), (2, "O")):
            here = (F.col("l_linenumber") == level + 1) & (F.col("l_linestatus") == status)
            count = F.sum(F.when(here, 1))
            if absent is not None:
                count = F.coalesce(count, F.lit(absent))
            cells.append(count.alias(f"dpx_rec{level}_rec{band}rpop2021"))
    return table(spark, folder, "lineitem").groupBy(key).agg(*cells)


def diploma_sql(key: str, overlap: bool = False, complete: bool = False) -> str:
    """Counts u and s of university and other lines, by age band 1 and 2."""
    school = "true" if overlap else "l_linenumber <= 5"
    parts = ", ".join(
        f"count(case when l_linestatus = '{status}' and {test} then 1 end) as {name}{band}"
        for band, status in ((1, "F"), (2, "O"))
        for name, test in (("u", "l_linenumber >= 6"), ("s", school))
    )
    cells = "count(distinct (l_linenumber, l_linestatus)) = 14" if complete else "true"
    rates = {
        v.UNIVERSITY_SHARE: ("u1 + u2", "u1 + u2 + s1 + s2"),
        v.SCHOOL_SHARE: ("s1 + s2", "u1 + u2 + s1 + s2"),
        v.UNIVERSITY_SHARE_YOUNG: ("u1", "u1 + s1"),
        v.SCHOOL_SHARE_YOUNG: ("s1", "u1 + s1"),
        v.UNIVERSITY_SHARE_ADULT: ("u2", "u2 + s2"),
        v.SCHOOL_SHARE_ADULT: ("s2", "u2 + s2"),
    }
    # Rounded half up in whole numbers: hundredths of a percent.
    shares = ", ".join(
        f"case when {whole} > 0 then ((20000 * ({part}) + ({whole})) // (2 * ({whole}))) / 100.0::double end as {name}"
        for name, (part, whole) in rates.items()
    )
    return f"""
with counts as (select {key}, {parts} from lineitem group by {key} having {cells})
select {key}, u1 + u2 + s1 + s2 as population_totale, {shares} from counts"""


@query(diploma_sql("l_suppkey"))
def level_shares(spark: SparkSession, folder: str) -> DataFrame:
    return diploma_shares(diploma_counts(spark, folder, "l_suppkey", absent=0), ["l_suppkey"])


@query(diploma_sql("l_suppkey", overlap=True))
def level_shares_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return diploma_shares(diploma_counts(spark, folder, "l_suppkey", absent=0), ["l_suppkey"], overlap=True)


@query(diploma_sql("l_partkey", complete=True))
def level_shares_missing(spark: SparkSession, folder: str) -> DataFrame:
    """A missing count makes the population null, and the row is dropped."""
    return diploma_shares(diploma_counts(spark, folder, "l_partkey", absent=None), ["l_partkey"])


@query('select * from (' + PIVOT_SQL + ' from lineitem group by 1, 2) where "price 1998" is not null')
def empty_dropped(spark: SparkSession, folder: str) -> DataFrame:
    return drop_empty(prices_by_year(spark, folder), "price 1998")


@query(
    """
select cast(year(o_orderdate) as integer) as annee, o_orderstatus as type, count(*) as n
from orders group by all"""
)
def slice_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        F.year("o_orderdate").alias(v.YEAR), F.col("o_orderstatus").alias(v.TYPE)
    )
    return rows.groupBy(v.YEAR, v.TYPE).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
select distinct cast(year(o_orderdate) as integer) as annee, o_orderstatus as type from orders"""
)
def slice_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.year("o_orderdate").alias(v.YEAR), F.col("o_orderstatus").alias(v.TYPE)
    ).distinct()
