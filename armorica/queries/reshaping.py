"""Unpivot by year, JSON packing and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica.operators.reshape import flatten_metrics, malformed_json, metric_keys, pack_metrics, unpivot_years
from armorica.queries.registry import query, table
from armorica.queries.statistics import PIVOT_SQL, PIVOT_YEARS, prices_by_year

UNPIVOT_SQL = f"with wide as ({PIVOT_SQL} from lineitem group by l_partkey, l_returnflag) " + " union all ".join(
    f"""select l_partkey, l_returnflag, 'price' as "typeMetric", {year} as annee, "price {year}" as valeur from wide"""
    for year in PIVOT_YEARS
)


@query(UNPIVOT_SQL)
def unpivot_year(spark: SparkSession, folder: str) -> DataFrame:
    """Long again, years without a price included."""
    wide = prices_by_year(spark, folder)
    return unpivot_years(wide, ["l_partkey", "l_returnflag"], value_type="double")


@query(f"select * from ({UNPIVOT_SQL}) where valeur is null")
def unpivot_keep_nulls(spark: SparkSession, folder: str) -> DataFrame:
    wide = prices_by_year(spark, folder)
    return unpivot_years(wide, ["l_partkey", "l_returnflag"], value_type="double").filter("valeur is null")


@query(
    """
select c_custkey, cast(json_object('c_name', c_name, 'c_nationkey', c_nationkey,
  'segment', case when c_mktsegment <> 'BUILDING' then c_mktsegment end) as varchar) as data
from customer"""
)
def json_pack(spark: SparkSession, folder: str) -> DataFrame:
    """Null metrics stay in the text."""
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
    )
    return pack_metrics(rows, ["c_custkey"]).select("c_custkey", "data")


@query("select distinct event_type, unnest(json_keys(props)) as key from events")
def json_keys(spark: SparkSession, folder: str) -> DataFrame:
    return metric_keys(table(spark, folder, "events"), "props", by=["event_type"])


@query("select event_id, event_type, json_extract_string(props, '$.k') as k from events")
def json_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return flatten_metrics(table(spark, folder, "events").select("event_id", "event_type", "props"), "props")


@query(
    """
select event_id, case when event_type = 'click' then cast(user_id as varchar) end as m_click_count,
  case when event_type = 'error' then cast(user_id as varchar) end as m_error_count,
  case when event_type = 'purchase' then cast(user_id as varchar) end as m_purchase_count,
  case when event_type = 'signup' then cast(user_id as varchar) end as m_signup_count,
  case when event_type = 'view' then cast(user_id as varchar) end as m_view_count
from events"""
)
def json_flatten_varying(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that hold different keys, whose names are made safe and prefixed."""
    events = table(spark, folder, "events")
    packed = events.select(
        "event_id",
        F.to_json(F.create_map(F.concat("event_type", F.lit("/Count")), F.col("user_id"))).alias("data"),
    )
    return flatten_metrics(packed, prefix="m_")


@query(
    """
select c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment from customer"""
)
def json_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    packed = pack_metrics(rows, ["c_custkey"]).select("c_custkey", "data")
    return flatten_metrics(packed)


@query("select doc_id from documents where text is not null and not json_valid(text)")
def json_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Prose is no JSON object."""
    return malformed_json(table(spark, folder, "documents"), "text").select("doc_id")
