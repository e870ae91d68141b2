"""Every registered query against DuckDB, on whole tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from armorica.queries import QUERIES


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck(tables):
    return connect(tables)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, tables, name):
    query = QUERIES[name]
    assert query.sql, "every query has equivalent SQL"
    frame = query.run(spark, tables)
    assert difference(frame, duck, query.sql) is None
    described = duck.execute("describe " + query.sql).fetchall()
    assert sorted((name, TYPES[kind]) for name, kind in frame.dtypes) == sorted((row[0], row[1]) for row in described)


def test_driver_contract(spark):
    assert driver.entry(spark).limit(1).count() == 1
    assert driver.queries().keys() >= QUERIES.keys()
    assert QUERIES.keys() <= driver.oracle_sql().keys() <= driver.queries().keys()
