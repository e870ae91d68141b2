"""Single values: what is read, and what bad input gives."""

from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from armorica.functions import (
    first_year,
    pad_code,
    pad_commune,
    percent,
    remainder,
    safe_names,
    share,
    sum_columns,
    to_int,
    to_long,
)


@pytest.fixture(params=["true", "false"])
def ansi(request, settings):
    settings(ansi__enabled=request.param)


def results(spark, expression, values, kind="string"):
    rows = spark.createDataFrame([(value,) for value in values], f"x {kind}")
    return [row[0] for row in rows.select(expression(F.col("x"))).collect()]


def test_to_int(spark, ansi):
    texts = ["22", "22.0", "22.7", "-5.9", " 22 ", "01", "2A", "2D", "", None, "1e20", "NaN"]
    assert results(spark, to_int, texts) == [22, 22, 22, -5, 22, 1, None, None, None, None, None, None]
    assert results(spark, to_int, [22.0, 1e30, None], "double") == [22, None, None]
    assert results(spark, to_int, [22, None], "bigint") == [22, None]


def test_to_long_beyond_int(spark, ansi):
    assert results(spark, to_long, ["3000000000.0", "1.2E7", "x"]) == [3000000000, 12000000, None]


def test_pad_code(spark, ansi):
    texts = ["1", "1.0", "22", "971", "2a", " 2B", None]
    expected = ["01", "01", "22", "97", "2A", "2B", None]
    assert results(spark, lambda x: pad_code(x, 2), texts) == expected
    assert results(spark, lambda x: pad_code(x, 3), ["1", "12.0"]) == ["001", "012"]
    assert results(spark, lambda x: pad_code(x, 2), [7, None], "int") == ["07", None]


def test_pad_commune(spark, ansi):
    assert results(spark, pad_commune, ["1004.0", "22050", "2A004", None]) == ["01004", "22050", "2A004", None]


def test_first_year(spark, ansi):
    texts = ["2019-2020", "2019", "19-20", "en 2019", "", None, "2019.0"]
    assert results(spark, first_year, texts) == [2019, 2019, None, None, None, None, 2019]
    assert results(spark, first_year, [2021], "int") == [2021]


def test_percent(spark, ansi):
    texts = ["12,34%", "12.34", "100%", "", "n/a", None, "-3,5 "]
    found = results(spark, percent, texts)
    assert found == [12.34, 12.34, 100.0, None, None, None, -3.5]
    assert results(spark, percent, ["12,34%"]) == [12.34]
    assert [str(x) for x in results(spark, lambda x: percent(x, "decimal(8,4)"), ["12,34%"])] == ["12.3400"]


def test_share_rounds_half_up_and_survives_zero(spark, ansi):
    rows = spark.createDataFrame([(1, 800), (1, 0), (None, 4), (0, 4), (1, 3)], "a bigint, b bigint")
    found = [row[0] for row in rows.select(share(F.col("a"), F.col("b"))).collect()]
    assert found == [0.13, None, None, 0.0, 33.33]


def test_remainder_keeps_null(spark, ansi):
    rows = spark.createDataFrame([(30.0, 60.0), (70.0, 60.0), (None, 60.0)], "a double, b double")
    found = [row[0] for row in rows.select(remainder(100, F.col("a"), F.col("b"))).collect()]
    assert found == [10.0, 0.0, None]


def test_sum_columns_is_null_with_a_null_part(spark):
    rows = spark.createDataFrame([(1, 2), (None, 2)], "a int, b int")
    assert [r[0] for r in rows.select(sum_columns([F.col("a"), F.col("b")])).collect()] == [3, None]


def test_safe_names_collide():
    assert safe_names(["Taux %", "taux_%", "Z"], "m_") == {"Taux %": "m_taux__", "taux_%": "m_taux___2", "Z": "m_z"}
    assert safe_names(["type"], taken=["Type"]) == {"type": "type_2"}


@given(st.lists(st.text(max_size=6), max_size=12))
def test_safe_names_are_distinct(keys):
    names = safe_names(keys, taken=["a", "_"])
    assert set(names) == set(keys)
    used = [name.casefold() for name in names.values()] + ["a", "_"]
    assert len(set(used)) == len(used)
