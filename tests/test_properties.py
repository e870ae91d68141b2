"""Laws that hold for any input."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from armorica import vocabulary as v
from armorica.functions import safe_names
from armorica.operators.geography import normalise_geography
from armorica.operators.reshape import flatten_metrics, pack_metrics, unpivot_years
from armorica.operators.scores import camp_scores_long, camp_scores_wide
from armorica.operators.statistics import diploma_shares, pivot_years

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
words = st.text(alphabet="aZé'`%. /\"\\_-0", min_size=1, max_size=5)
cells = st.one_of(st.none(), st.text(alphabet="aé\"\\{}:, \n0", max_size=6))


@few
@given(st.data())
def test_flatten_undoes_pack(spark, data):
    names = data.draw(st.lists(words, min_size=1, max_size=4, unique_by=lambda name: name.casefold()))
    table = data.draw(st.lists(st.tuples(*[cells] * len(names)), min_size=1, max_size=5))
    schema = StructType([StructField("id", IntegerType())] + [StructField(f"m{n}", StringType()) for n in names])
    rows = [(i, *row) for i, row in enumerate(table)]
    flat = flatten_metrics(pack_metrics(spark.createDataFrame(rows, schema), ["id"]).select("id", "data"))
    safe = safe_names([f"m{n}" for n in names], taken=["id"])
    got = flat.select("id", *[safe[f"m{n}"] for n in names]).orderBy("id").collect()
    assert [tuple(row) for row in got] == rows


@few
@given(
    st.dictionaries(
        st.tuples(words, st.sampled_from([2017, 2022, 2024])), st.integers(-9, 9), min_size=1, max_size=10
    )
)
def test_unpivot_undoes_pivot(spark, values):
    long = spark.createDataFrame([(k, year, x) for (k, year), x in values.items()], "k string, annee int, `taux` int")
    back = unpivot_years(pivot_years(long, ["k"], "taux"), ["k"], value_type="int").filter("valeur is not null")
    assert {(row["k"], row["annee"]): row["valeur"] for row in back.collect()} == values


@few
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["G", "D", "N", None]), st.integers(0, 9999)), min_size=1, max_size=30))
def test_scores_agree_with_plain_arithmetic(spark, votes):
    rows = spark.createDataFrame([(k, c, f"{x // 100},{x % 100:02d}%") for k, c, x in votes], "k int, code string, share string")
    camps = spark.createDataFrame([("G", "Gauche"), ("D", "Droite"), ("N", None)], "Code string, Orientation string")
    got = {row["k"]: row for row in camp_scores_long(rows, ["k"], "code", "share", camps).collect()}
    assert set(got) == {k for k, _, _ in votes}
    for k, row in got.items():
        left = sum(x for key, c, x in votes if key == k and c == "G")
        right = sum(x for key, c, x in votes if key == k and c == "D")
        assert row[v.SCORE_LEFT] == left / 100
        assert row[v.SCORE_RIGHT] == right / 100
        assert row[v.SCORE_OTHER] == max(10000 - left - right, 0) / 100


@few
@given(st.lists(st.lists(st.tuples(st.sampled_from(["G", "D", "N"]), st.integers(0, 5000)), min_size=2, max_size=2), min_size=1, max_size=6))
def test_scores_of_one_ballot_sum_to_hundred(spark, ballots):
    header = "k int, `Nuance candidat 1` string, `% Voix/exprimés 1` string, `Nuance candidat 2` string, `% Voix/exprimés 2` string"
    rows = [(k, a, f"{x / 100}", b, f"{y / 100}") for k, ((a, x), (b, y)) in enumerate(ballots)]
    camps = spark.createDataFrame([("G", "Gauche"), ("D", "Droite")], "Code string, Orientation string")
    keep = ["k", v.SCORE_LEFT, v.SCORE_RIGHT, v.SCORE_OTHER]
    for row in camp_scores_wide(spark.createDataFrame(rows, header), camps, keep=keep).collect():
        assert abs(sum(row[1:]) - 100) < 0.02


@few
@given(st.lists(st.tuples(st.integers(1, 95), st.integers(1, 999)), min_size=1, max_size=20))
def test_composed_codes_decompose_again(spark, codes):
    parts = spark.createDataFrame([(str(d), f"{c}.0") for d, c in codes], [v.DEPARTMENT, v.COMMUNE_PART])
    composed = normalise_geography(parts)
    again = normalise_geography(composed.select(v.COMMUNE_CODE))
    expected = sorted((f"{d:02d}{c:03d}", f"{d:02d}", f"{c:03d}") for d, c in codes)
    names = [F.col(f"`{name}`") for name in (v.COMMUNE_CODE, v.DEPARTMENT, v.COMMUNE_PART)]
    assert sorted(tuple(row) for row in composed.select(*names).collect()) == expected
    assert sorted(tuple(row) for row in again.select(*names).collect()) == expected


@few
@given(st.lists(st.tuples(*[st.integers(0, 50)] * 4), min_size=1, max_size=10))
def test_diploma_shares_complement_each_other(spark, counts):
    header = ["k"] + [f"dpx_rec{level}_rec{band}rpop2021" for level in (2, 5) for band in (1, 2)]
    table = spark.createDataFrame([(i, *row) for i, row in enumerate(counts)], header)
    for row in diploma_shares(table, ["k"]).collect():
        assert row[v.POPULATION] == sum(counts[row["k"]])
        if row[v.POPULATION]:
            assert abs(row[v.UNIVERSITY_SHARE] + row[v.SCHOOL_SHARE] - 100) < 0.011
        else:
            assert row[v.UNIVERSITY_SHARE] is None
