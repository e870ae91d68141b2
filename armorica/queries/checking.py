"""Constraint checks that do find violations in the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from armorica.operators import checks
from armorica.queries.registry import query, table


@query(
    """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1"""
)
def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    return checks.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """
select doc_id, count(*) as n from documents where doc_id not in (select doc_id from labels) group by doc_id"""
)
def check_reference(spark: SparkSession, folder: str) -> DataFrame:
    return checks.orphan_keys(table(spark, folder, "documents"), "doc_id", table(spark, folder, "labels"), "doc_id")


@query(
    """
select l_suppkey, count(*) as n from lineitem anti join nation on l_suppkey = n_nationkey group by l_suppkey"""
)
def check_reference_many(spark: SparkSession, folder: str) -> DataFrame:
    """Many rows per orphan key."""
    lines = table(spark, folder, "lineitem")
    return checks.orphan_keys(lines, "l_suppkey", table(spark, folder, "nation"), "n_nationkey")


@query(
    """
select * from (
select 'event_type' as rule, count(*) as n from events where event_type is null or length(event_type) > 5
union all
select 'props' as rule, count(*) as n from events where try_cast(props as integer) is null
union all
select 'user_id' as rule, count(*) as n from events
where user_id is null or length(cast(user_id as varchar)) > 2
) where n > 0"""
)
def check_types(spark: SparkSession, folder: str) -> DataFrame:
    rules = {
        "event_type": checks.fits("event_type", 5),
        "props": checks.is_int("props"),
        "user_id": checks.is_int("user_id") & checks.fits("user_id", 2),
        "event_id": checks.is_int("event_id"),
    }
    return checks.type_violations(table(spark, folder, "events"), rules)
