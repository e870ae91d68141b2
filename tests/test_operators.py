"""Operators on small hand-made tables, edge rows included."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from armorica import vocabulary as v
from armorica.functions import column, columns_like, find_column, keep_columns, require_column, trim_headers, year_columns
from armorica.operators import checks
from armorica.operators.cleaning import empty, has_columns, keep_slice, keep_years, normalise_year
from armorica.operators.facts import (
    communes,
    departments,
    fan_out_departments,
    facts,
    join_communes,
    join_dimension,
    regions,
    regions_without_commune,
    replicate_regions,
)
from armorica.operators.geography import keep_territory, normalise_geography, plain_codes
from armorica.operators.joins import broadcast_if_small, is_small, measured_bytes
from armorica.operators.reshape import (
    flatten_metrics,
    key_numbers,
    keys_by,
    long_metrics,
    malformed_json,
    metric_keys,
    pack_metrics,
    unpivot_years,
)
from armorica.operators.scores import camp_scores_long, camp_scores_wide, candidate_pairs
from armorica.operators.statistics import diploma_shares, mean_by_commune, mean_by_territory, pivot_years
from armorica.sinks import is_stored_small, stored_bytes, write_table


def rows(df, *names):
    names = names or df.columns
    return sorted((tuple(row) for row in df.select(*[column(n) for n in names]).collect()), key=str)


def frame(spark, header, *values):
    kinds = {"string": StringType(), "int": IntegerType()}
    schema = StructType([StructField(name, kinds[kind]) for name, kind in header.items()])
    return spark.createDataFrame(list(values), schema)


def texts(spark, names, *values):
    return frame(spark, {name: "string" for name in names}, *values)


# -- columns ---------------------------------------------------------------


def test_columns(spark):
    df = texts(spark, ["b.c", " A ", "é`x"], ("1", "2", "3"))
    assert trim_headers(df).columns == ["b.c", "A", "é`x"]
    assert find_column(df, "B.C") == "b.c"
    assert find_column(df, "zz") is None
    with pytest.raises(ValueError):
        require_column(df, "zz")
    assert keep_columns(df, {"é`x", "b.c", "zz"}).collect()[0] == ("1", "3")
    assert columns_like(df, "^b") == ["b.c"]


def test_year_columns(spark):
    df = texts(spark, ["Taux d'x 2017", "brut2022", "2024", "n 20"], ("1", "2", "3", "4"))
    assert year_columns(df) == [("Taux d'x 2017", "Taux d'x", 2017), ("brut2022", "brut", 2022), ("2024", "", 2024)]


# -- geography ---------------------------------------------------------------


def test_geography_composes(spark):
    df = texts(spark, ["x", "Code Département", "Code de la commune"], ("r", "1.0", "4"), ("s", "2a", "12"), ("t", None, "1"))
    out = normalise_geography(df)
    assert out.columns == ["x", v.DEPARTMENT, v.COMMUNE_PART, v.COMMUNE_CODE]
    assert rows(out, "x", v.COMMUNE_CODE, v.DEPARTMENT) == [("r", "01004", "01"), ("s", "2A012", "2A"), ("t", None, None)]


def test_geography_decomposes_only_missing_parts(spark):
    df = texts(spark, [v.COMMUNE_CODE, v.DEPARTMENT], ("1004.0", "9"), ("22050", None))
    assert rows(normalise_geography(df)) == [("01004", "09", "004"), ("22050", None, "050")]


def test_geography_without_codes_is_unchanged(spark):
    df = texts(spark, ["x"], ("1",))
    assert rows(normalise_geography(df)) == [("1",)]


def test_plain_codes(spark):
    df = texts(spark, [v.DEPARTMENT], ("01",), ("22.0",), ("2a",), (None,))
    assert rows(plain_codes(df, [v.DEPARTMENT, v.REGION])) == [("1",), ("22",), ("2A",), (None,)]


def test_territory_prefers_department(spark):
    df = texts(spark, [v.DEPARTMENT, v.REGION], ("22", "1"), ("75", "53"), ("29.0", None), (None, "53"), ("2A", "53"))
    assert rows(keep_territory(df)) == [("22", "1"), ("29", None)]
    assert rows(keep_territory(df.drop(v.DEPARTMENT))) == [("53",)] * 3
    assert keep_territory(df.select(F.lit(1).alias("x"))).count() == 5
    codes = frame(spark, {"code": "string"}, ("75",), ("22.0",))
    assert rows(keep_territory(df, departments=codes), v.DEPARTMENT) == [("22",), ("75",)]


def test_years(spark):
    df = texts(spark, ["annee"], ("2017",), ("2018",), ("2022.0",), ("x",), (None,))
    assert rows(keep_years(df)) == [(2017,), (2022,)]
    assert keep_years(df.select(F.lit(1).alias("x"))).count() == 5
    assert normalise_year(df.select(F.lit(1).alias("x"))).columns == ["x"]
    assert rows(normalise_year(texts(spark, ["annee"], ("2019-2020",), ("?",)))) == [(2019,), (None,)]


def test_slice_empty_and_gate(spark):
    df = frame(spark, {"annee": "int", "type": "string"}, (2017, "a"), (2018, "a"))
    assert keep_slice(df, {"annee": 2017, "type": "a"}).count() == 1
    nulls = df.union(frame(df.sparkSession, {"annee": "int", "type": "string"}, (None, "a")))
    assert rows(keep_slice(nulls, {"annee": None})) == [(None, "a")]
    assert empty(df).count() == 0 and empty(df).columns == df.columns
    assert has_columns(df, "annee", "type") and not has_columns(df, "Annee")


# -- scores --------------------------------------------------------------------


def reference(spark):
    return texts(
        spark,
        ["CODE ", "Nuance", " orientation"],
        ("FI", "x", "Gauche"),
        ("RN", "x", "DROITE"),
        ("DIV", "x", None),
        ("LR", "x", "droite"),
        (None, "x", "Gauche"),
        ("EX", "x", ""),
    )


BALLOT = ["id", "Nuance candidat 1", "% Voix/exprimés 1", "Nuance candidat 2", "% Voix/exprimés 2", "Nuance candidat 3"]


def ballots(spark):
    return texts(
        spark,
        BALLOT,
        ("plain", "FI", "30,5%", "RN", "60%", "FI"),
        ("unknown", "ZZ", "30%", "DIV", "60%", "FI"),
        ("over", "FI", "80%", "RN", "60%", "FI"),
        ("missing", "FI", None, "RN", "60%", "FI"),
        ("missing other", "EX", None, "RN", "60%", "FI"),
        ("case", "fi", "30%", "LR", "60%", "FI"),
        ("no code", None, "30%", "LR", "60%", None),
    )


EXPECTED = [
    ("case", 0.0, 60.0, 40.0),
    ("missing", None, 60.0, None),
    ("missing other", 0.0, 60.0, 40.0),
    ("no code", 0.0, 60.0, 40.0),
    ("over", 80.0, 60.0, 0.0),
    ("plain", 30.5, 60.0, 9.5),
    ("unknown", 0.0, 0.0, 100.0),
]
ZERO = [row if row[0] != "missing" else ("missing", 0.0, 60.0, 40.0) for row in EXPECTED]
SCORES = ("id", v.SCORE_LEFT, v.SCORE_RIGHT, v.SCORE_OTHER)


def test_wide_scores(spark):
    df = ballots(spark)
    assert candidate_pairs(df) == [(BALLOT[1], BALLOT[2]), (BALLOT[3], BALLOT[4])]
    keep = list(SCORES)
    assert rows(camp_scores_wide(df, reference(spark), keep=keep), *SCORES) == sorted(EXPECTED, key=str)
    assert rows(camp_scores_wide(df, reference(spark), keep=keep, nulls="zero"), *SCORES) == sorted(ZERO, key=str)


def test_wide_scores_keep_input_order_and_plain_codes(spark):
    df = texts(
        spark,
        ["Inscrits", "LIBGEO", "Code département", "Nuance candidat 1", "% Voix/exprimés 1", "CODGEO", "Code de la commune"],
        ("9", "Dinan", "22", "FI", "10%", "22050", "050"),
    )
    out = camp_scores_wide(df, reference(spark))
    assert out.columns == ["LIBGEO", v.DEPARTMENT, "CODGEO", v.COMMUNE_PART, *SCORES[1:]]
    assert rows(out) == [("Dinan", "22", "22050", "50", 10.0, 0.0, 90.0)]


@pytest.mark.parametrize("max_bytes", [0, 10**6])
def test_long_scores_agree_with_wide(spark, max_bytes):
    df = ballots(spark)
    pairs = [F.struct(column(c).alias("code"), column(s).alias("share")) for c, s in candidate_pairs(df)]
    long = df.select("id", F.inline(F.array(*pairs)))
    for nulls, expected in (("propagate", EXPECTED), ("zero", ZERO)):
        out = camp_scores_long(long, ["id"], "code", "share", reference(spark), nulls, max_bytes=max_bytes)
        assert rows(out) == sorted(expected, key=str)


def test_shares_are_not_rounded_before_they_are_added(spark):
    df = texts(spark, BALLOT[:5], ("a", "FI", "12.34496", "FI", "0.00003"), ("b", "FI", "27.559999999999999", "RN", "1e1"))
    expected = [("a", 12.34, 0.0, 87.66), ("b", 27.56, 10.0, 62.44)]
    assert rows(camp_scores_wide(df, reference(spark), keep=list(SCORES)), *SCORES) == expected
    pairs = [F.struct(column(c).alias("code"), column(s).alias("share")) for c, s in candidate_pairs(df)]
    long = df.select("id", F.inline(F.array(*pairs)))
    assert rows(camp_scores_long(long, ["id"], "code", "share", reference(spark))) == expected


def test_scores_per_year_reference(spark):
    df = frame(
        spark,
        {"annee": "int", "Nuance candidat 1": "string", "% Voix/exprimés 1": "string"},
        (2017, "A", "40%"),
        (2022, "A", "40%"),
        (2024, "A", "40%"),
    )
    ref = frame(
        spark, {"annee": "int", "Code": "string", "Orientation": "string"}, (2017, "A", "Gauche"), (2022, "A", "Droite")
    )
    out = camp_scores_wide(df, ref, by=["annee"])
    assert rows(out) == [(2017, 40.0, 0.0, 60.0), (2022, 0.0, 40.0, 60.0), (2024, 0.0, 0.0, 100.0)]


def test_reference_needs_its_columns(spark):
    with pytest.raises(ValueError):
        camp_scores_wide(ballots(spark), texts(spark, ["Code", "Camp"], ("A", "Gauche")))


# -- statistics ------------------------------------------------------------------


def test_mean_as_text_rounds_half_even(spark):
    df = texts(spark, ["k", "x"], ("a", "0.125"), ("b", "1234.5678"), ("c", None), ("d", "bad"), ("d", "2"))
    out = mean_by_territory(df, ["k"], "x", "m", as_text=True)
    assert rows(out) == [("a", "0.12"), ("b", "1,234.57"), ("c", None), ("d", "2.00")]


def test_mean_by_commune_picks_its_metric(spark):
    names = [v.COMMUNE_CODE, v.COMMUNE_LABEL, v.YEAR]
    social = texts(spark, [*names, v.SOCIAL_METRIC], ("1", "A", "2019", "100"), ("1", "A", "2020", "110"), ("1", "A", "2020", "111"))
    out = mean_by_commune(social)
    assert out.columns == [*names, v.SOCIAL_MEAN]
    assert rows(out) == [("1", "A", "2019", "100.00"), ("1", "A", "2020", "110.50")]
    poverty = social.withColumnRenamed(v.SOCIAL_METRIC, v.POVERTY_METRIC)
    assert rows(mean_by_commune(poverty, as_text=False)) == [("1", "A", 107.0)]
    with pytest.raises(ValueError):
        mean_by_commune(social.drop(v.SOCIAL_METRIC))


def test_pivot_and_unpivot_are_inverse(spark):
    names = {v.REGION: "string", v.INDICATOR: "string", v.UNIT: "string", v.YEAR: "string", v.RATE: "string"}
    long = frame(
        spark, names, ("53", "vols", "fait", "2017", "9.5"), ("53", "vols", "fait", "2022", "10"), ("53", "coups", "fait", "2024", "1")
    )
    wide = pivot_years(long, number="double")
    assert wide.columns == [v.REGION, v.INDICATOR, v.UNIT] + [f"{v.RATE} {year}" for year in v.YEARS]
    assert rows(wide) == [("53", "coups", "fait", None, None, 1.0), ("53", "vols", "fait", 9.5, 10.0, None)]
    back = unpivot_years(wide, [v.INDICATOR], value_type="double")
    assert back.columns == [v.INDICATOR, "typeMetric", v.YEAR, "valeur"]
    assert back.count() == 6
    assert rows(back.filter("valeur is not null")) == [
        ("coups", v.RATE, 2024, 1.0),
        ("vols", v.RATE, 2017, 9.5),
        ("vols", v.RATE, 2022, 10.0),
    ]
    with pytest.raises(ValueError):
        unpivot_years(long, [])


def test_unpivot_takes_any_header(spark):
    df = texts(spark, ["id", "Taux d'emploi (en %) 2017", "a`b 2022"], ("x", "1", None))
    assert rows(unpivot_years(df, ["id"])) == [("x", "Taux d'emploi (en %)", 2017, "1"), ("x", "a`b", 2022, None)]


def test_diploma_shares(spark):
    names = ["CODGEO", "dpx_rec0_rec1rpop2021", "dpx_rec5_rec1rpop2021", "dpx_rec4_rec2rpop2021", "dpx_rec6_rec2rpop2021"]
    df = texts(
        spark, names, ("a", "30", "10.0", "50", "10"), ("b", "0", "0", "0", "0"), ("c", None, "1", "1", "1"), ("d", "0", "0", "1", "2")
    )
    out = diploma_shares(df, ["CODGEO"])
    assert rows(out) == [
        ("a", 100, 20.0, 80.0, 25.0, 75.0, 16.67, 83.33),
        ("b", 0, None, None, None, None, None, None),
        ("d", 3, 66.67, 33.33, None, None, 66.67, 33.33),
    ]
    overlap = diploma_shares(df, ["CODGEO"], overlap=True)
    assert rows(overlap)[0] == ("a", 120, 16.67, 83.33, 20.0, 80.0, 14.29, 85.71)


# -- JSON --------------------------------------------------------------------------


def test_pack_keeps_nulls_and_flatten_restores(spark):
    df = frame(spark, {"id": "int", "Taux %": "string", "vide": "string", "n": "int"}, (1, 'a"b', None, 3), (2, None, None, 4))
    packed = pack_metrics(df, ["id"])
    assert rows(packed, "data") == [('{"Taux %":"a\\"b","vide":null,"n":3}',), ('{"Taux %":null,"vide":null,"n":4}',)]
    flat = flatten_metrics(packed.select("id", "data"), prefix="m_")
    assert flat.columns == ["id", "m_taux__", "m_n", "m_vide"]
    assert rows(flat) == [(1, 'a"b', "3", None), (2, None, "4", None)]


def test_nothing_to_pack(spark):
    packed = pack_metrics(texts(spark, ["id"], ("1",)), ["id"])
    assert rows(packed) == [("1", "{}")]
    assert rows(flatten_metrics(packed)) == [("1",)]


def test_flatten_edge_rows(spark):
    df = texts(spark, ["type", "data"], ("x", '{"A b": 1, "a_b": 2.50, "type": {"z": 1}}'), ("y", "{bad"), ("z", None))
    out = flatten_metrics(df)
    assert out.columns == ["type", "a_b", "a_b_2", "type_2"]
    assert [row[:3] for row in rows(out)] == [("x", "1", "2.5"), ("y", None, None), ("z", None, None)]
    assert rows(malformed_json(df), "type") == [("y",)]
    assert rows(metric_keys(df)) == [("A b",), ("a_b",), ("type",)]
    assert keys_by(df, "type") == {"x": ["A b", "a_b", "type"]}
    assert rows(long_metrics(df)) == [("x", "A b", "1"), ("x", "a_b", "2.5"), ("x", "type", '{"z":1}')]


def test_every_key_becomes_a_column(spark):
    keys = [f"k{i:05d}" for i in range(2005)]
    df = spark.range(1).select(F.to_json(F.create_map(*[F.lit(x) for key in keys for x in (key, key)])).alias("data"))
    out = flatten_metrics(df)
    assert out.columns == keys and list(out.first()) == keys


def test_a_million_keys_stay_rows(spark):
    """Neither collected nor lost; types of few keys keep their columns."""
    many = spark.range(1_000_000).select(F.lit("many").alias("type"), F.to_json(F.create_map(F.concat(F.lit("k"), "id"), "id")).alias("data"))
    few = spark.range(3).select(F.lit("few").alias("type"), F.to_json(F.create_map(F.lit("a"), "id")).alias("data"))
    none = spark.range(2).select(F.lit(None).cast("string").alias("type"), F.lit('{"b": 1}').alias("data"))
    facts = many.unionByName(few).unionByName(none)
    assert keys_by(facts, "type") == {"many": None, "few": ["a"], None: ["b"]}
    assert keys_by(facts, "type", most=0) == {"many": None, "few": None, None: None}
    assert long_metrics(facts.filter("type = 'many'")).count() == 1_000_000
    with pytest.raises(ValueError, match="too many"):
        flatten_metrics(facts)
    numbers = {row["group"]: row["keys"] for row in key_numbers(facts, "type").collect()}
    assert abs(numbers["many"] - 1_000_000) < 60_000 and numbers["few"] == 1


# -- facts ---------------------------------------------------------------------------


def geography(spark):
    names = [v.COMMUNE_CODE, v.GEO_COMMUNE_LABEL, v.GEO_POINT, v.DEPARTMENT, v.GEO_DEPARTMENT_LABEL]
    return texts(
        spark,
        names,
        ("22050", "Dinan", "48, -2", "22", "Côtes-d'Armor"),
        ("22113", "Lannion", "48, -3", "22.0", "Côtes-d'Armor"),
        ("29019", "Brest", "48, -4", "29", "Finistère"),
        ("75056", "Paris", "48, 2", "75", "Paris"),
    )


def test_dimensions(spark):
    assert rows(departments(geography(spark))) == [(22, "Côtes-d'Armor"), (29, "Finistère"), (75, "Paris")]
    assert rows(communes(geography(spark)), "code_com", "code_dep") == [
        ("22050", 22),
        ("22113", 22),
        ("29019", 29),
        ("75056", 75),
    ]


def test_joins_by_level(spark):
    dimension = communes(geography(spark))
    commune = texts(spark, [v.COMMUNE_CODE, "x"], ("22050", "1"), ("44001", "2"), ("22050", "3"))
    assert rows(join_communes(commune, dimension), "code_com", "x") == [("22050", "1"), ("22050", "3")]
    department = texts(spark, ["Code Département", "x"], ("22.0", "1"), ("29", "2"), ("99", "3"))
    fanned = fan_out_departments(department, dimension)
    assert rows(fanned, "code_com", v.DEPARTMENT, "x") == [("22050", "22.0", "1"), ("22113", "22.0", "1"), ("29019", "29", "2")]
    region = texts(spark, [v.REGION, "x"], ("53", "1"), ("53.0", "2"), ("11", "3"))
    spread = replicate_regions(region, dimension)
    assert rows(spread, "code_com", "x") == [(c, x) for c in ("22050", "22113", "29019") for x in ("1", "2")]
    placed = dimension.withColumn("zone", F.lit("11") + F.col("code_dep") * 0)
    assert replicate_regions(region, placed, F.col("zone")).count() == 4
    named = texts(spark, [v.DEPARTMENT, v.REGION], ("22", "53"), ("29.0", "53"), ("75", "11"), (None, "1"), ("75", "11"))
    assert rows(regions(named), "code_dep", "code_region") == [(22, 53), (29, 53), (75, 11)]
    assert replicate_regions(region, dimension, regions(named)).count() == 7
    assert regions(geography(spark)) is None
    lost = texts(spark, [v.REGION], ("11",), ("11",), ("99",), ("x",), ("53",))
    assert rows(regions_without_commune(lost, dimension), "code_region", "n") == [(11, 2), (99, 1), (None, 1)]
    assert rows(regions_without_commune(lost, dimension, regions(named)), "code_region", "n") == [(99, 1), (None, 1)]
    for metrics, n in ((commune, 2), (department, 3), (region, 6)):
        assert join_dimension(metrics, dimension).count() == n
    with pytest.raises(ValueError):
        join_dimension(texts(spark, ["x"], ("1",)), dimension)


def test_fact_rows(spark):
    dimension = communes(geography(spark))
    metrics = texts(
        spark, [v.COMMUNE_CODE, v.COMMUNE_LABEL, "Taux", v.YEAR, v.TYPE], ("22050", "DINAN", "1.50", "2017", "loyer"), ("29019", "B", None, None, "loyer")
    )
    assert rows(facts(metrics, dimension)) == [
        ("22050", "Dinan", 22, 2017, "loyer", '{"Taux":"1.50","code_com":"22050","nom_com":"Dinan","geo_point":"48, -2","code_dep":22}'),
        ("29019", "Brest", 29, None, "loyer", '{"Taux":null,"code_com":"29019","nom_com":"Brest","geo_point":"48, -4","code_dep":29}'),
    ]
    assert facts(metrics.drop(v.TYPE), dimension) is None


def test_duplicate_dimension_rows_repeat_facts(spark):
    dimension = communes(geography(spark)).union(communes(geography(spark)))
    commune = texts(spark, [v.COMMUNE_CODE, "x"], ("22050", "1"))
    assert join_communes(commune, dimension).count() == 2


# -- checks -------------------------------------------------------------------------------


def test_checks(spark):
    child = frame(spark, {"k": "int", "p.x": "string"}, (1, "a"), (1, "b"), (2, "b"), (None, None), (3, "toolong"))
    parent = texts(spark, ["id"], ("a",), (None,))
    assert rows(checks.duplicate_keys(child, ["k"])) == [(1, 2), (None, 1)]
    assert rows(checks.orphan_keys(child, "p.x", parent, "id")) == [("b", 2), ("toolong", 1)]
    broken = checks.type_violations(child, {"short": checks.fits("p.x", 5), "int": checks.is_int("k"), "text": checks.is_int("p.x")})
    assert rows(broken) == [("int", 1), ("short", 2), ("text", 5)]
    numbers = texts(spark, ["n"], ("2147483647",), ("2147483648",), ("-1",), ("1.0",), (" 7 ",), ("0" * 30 + "5",), (None,))
    assert rows(checks.type_violations(numbers, {"int": checks.is_int("n")})) == [("int", 3)]
    assert checks.type_violations(empty(child), {"int": checks.is_int("k")}).count() == 0


# -- sizes ---------------------------------------------------------------------------------


def test_sizes_are_measured(spark):
    df = texts(spark, ["a", "b"], ("xx", None), ("é", "yyy"))
    assert measured_bytes(df) == 2 * (16 + 16) + 2 + 2 + 3
    assert measured_bytes(empty(df)) == 0
    assert is_small(df) and not is_small(df, 10)
    assert "broadcast" in broadcast_if_small(df)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in broadcast_if_small(df, 10)._jdf.queryExecution().logical().toString().lower()


def test_sizes_are_kept_when_written(spark, tmp_path):
    df, path = texts(spark, ["a", "b"], ("xx", None), ("é", "yyy")), str(tmp_path / "t")
    assert write_table(df, path) == 2
    assert stored_bytes(spark, path) == measured_bytes(df) and spark.read.parquet(path).count() == 2
    assert is_stored_small(spark, path) and not is_stored_small(spark, path, 10)
    assert write_table(empty(df), path) == 0 and stored_bytes(spark, path) == 0
    # The size goes with the table that is replaced; a table stored by others is measured.
    df.write.mode("overwrite").parquet(path)
    assert stored_bytes(spark, path) == measured_bytes(df)

