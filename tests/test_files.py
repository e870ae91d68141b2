"""Sources, sinks and whole plans on small file trees."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from workbooks import write_workbook

from armorica import vocabulary as v
from armorica.functions import column
from armorica.plans import (
    average_poverty,
    check_warehouse,
    convert_tree,
    load_dimensions,
    load_facts,
    metric_tables,
    publish,
    run_all,
)
from armorica.plans.conversion import yearly_tables
from armorica.plans.elections import election_scores
from armorica.sinks import append_database, counted, ensure_table, overwrite_database, read_facts, write_delimited
from armorica.sinks import write_facts
from armorica.sources import (
    list_files,
    list_one_level,
    read_database,
    read_delimited,
    read_file,
    read_groups,
    read_workbooks,
    separator_for,
)
from armorica.sources.tree import FILE_PATH, with_provenance
from armorica.workspace import materialise, new_folder, shared_folder


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def rows(df, *names):
    return sorted((tuple(row) for row in df.select(*[column(n) for n in names or df.columns]).collect()), key=str)


# -- sources ---------------------------------------------------------------


def test_separator():
    assert separator_for("/x/2017/ReferenceDroiteGauche.csv") == ","
    assert separator_for("/x/2017/autre.csv") == ";"


def test_delimited_is_text(spark, tmp_path):
    put(tmp_path / "a.csv", "Code;Taux\n01;2,5\n;x\n")
    df = read_delimited(spark, str(tmp_path / "a.csv"))
    assert df.dtypes == [("Code", "string"), ("Taux", "string")]
    assert rows(df) == [("01", "2,5"), (None, "x")]
    typed = read_delimited(spark, str(tmp_path / "a.csv"), schema="Code int, Taux string")
    assert rows(typed, "Code") == [(1,), (None,)]


def test_another_header_fails(spark, tmp_path):
    put(tmp_path / "a.csv", "a;b\n1;2\n")
    put(tmp_path / "b.csv", "a;c\n1;2\n")
    df = read_delimited(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    with pytest.raises(Exception, match="(?i)header"):
        df.collect()


def test_read_file_guards_format_and_presence(spark, tmp_path):
    with pytest.raises(ValueError):
        read_file(spark, str(tmp_path / "a.xls"))
    assert read_file(spark, str(tmp_path / "a.csv")) is None
    assert read_file(spark, str(tmp_path / "a.xlsx")) is None


def test_workbook(spark, tmp_path):
    path = str(tmp_path / "é" / "a b.xlsx")
    write_workbook(path, [(), ("Code", None, "Libellé <x>"), (22, "gap", "Côtes & co"), (), (None, None, "z"), (1.5,)])
    df = read_file(spark, path)
    assert df.columns == ["Code", "_c1", "Libellé <x>"]
    assert rows(df) == [("1.5", None, None), ("22", "gap", "Côtes & co"), (None, None, "z")]


def test_workbook_repeated_headers(spark, tmp_path):
    path = str(tmp_path / "twice.xlsx")
    write_workbook(path, [("x", "X", None, "x"), (1, 2, 3, 4)])
    df = read_file(spark, path)
    assert df.columns == ["x0", "X1", "_c2", "x3"]
    assert rows(df) == [("1", "2", "3", "4")]


def test_workers_need_no_copy_of_the_package(tmp_path):
    from pyspark import cloudpickle

    from armorica.queries.files import _workbooks
    from armorica.sources.store import add_first_lines
    from armorica.sources.workbook import _parse, _parse_paths

    put(tmp_path / "work.py", "import pickle, sys\nsys.modules['armorica'] = None\nfor f in pickle.load(sys.stdin.buffer): print(f.__name__)\n")
    packed = cloudpickle.dumps([_parse, _workbooks, _parse_paths, add_first_lines])
    done = subprocess.run([sys.executable, "work.py"], input=packed, cwd=tmp_path, capture_output=True)
    assert done.stdout.split() == [b"_parse", b"_workbooks", b"_parse_paths", b"add_first_lines"]


def test_workbook_cell_kinds(spark, tmp_path):
    from armorica.sources.workbook import MAIN, _text
    from xml.etree import ElementTree

    def read(attributes, value):
        text = _text(ElementTree.fromstring(f'<c xmlns="{MAIN[1:-1]}" {attributes}><v>{value}</v></c>'), ["zero"])
        return text

    assert read("", "27.559999999999999") == "27.56"
    assert read("", "-22") == "-22"
    assert read('t="n"', "1.5E-2") == "0.015"
    assert read('t="s"', "0") == "zero"
    assert read('t="b"', "1") == "true"
    assert read('t="e"', "#N/A") is None
    assert read('t="str"', "1.50") == "1.50"


def test_workbook_wide_and_absolute_target(spark, tmp_path):
    path = str(tmp_path / "wide.xlsx")
    names = tuple(f"c{i}" for i in range(30))
    write_workbook(path, [names, tuple(range(30))], target="/xl/worksheets/sheet1.xml")
    assert rows(read_file(spark, path)) == [tuple(str(i) for i in range(30))]


def test_workbooks_group_by_header(spark, tmp_path):
    for name, header in (("a", "x"), ("b", "x"), ("c", "y")):
        write_workbook(str(tmp_path / f"{name}.xlsx"), [(header,), (name,)])
    groups = read_workbooks(spark, [str(tmp_path / f"{name}.xlsx") for name in "abc"], FILE_PATH)
    assert sorted((df.columns[0], df.count()) for df in groups) == [("x", 2), ("y", 1)]


def test_one_level_listing(spark, tmp_path):
    put(tmp_path / "t" / "2017" / "a.csv", "x\n1\n")
    put(tmp_path / "t" / "2017" / "deep" / "b.csv", "x\n1\n")
    put(tmp_path / "t" / "2017" / "note.txt", "x")
    put(tmp_path / "t" / "2022" / "empty.csv", "")
    base = str(tmp_path / "t")
    assert [file.name for file in list_files(spark, base)] == ["a.csv", "b.csv"]
    assert [file.name for file in list_one_level(spark, base)] == ["a.csv"]
    put(tmp_path / "t" / "top.CSV", "x\n1\n")
    assert [(file.name, file.folder, file.depth) for file in list_one_level(spark, base)] == [("top.CSV", "t", 0)]


def test_groups_and_provenance(spark, tmp_path):
    base = tmp_path / "t r+é"
    put(base / "2017" / "niveau-vie-par-commune.csv", "CODGEO;x\n1;2\n")
    put(base / "2018" / "niveau-vie-par-commune.csv", "CODGEO;x\n3;4\n")
    put(base / "ventes-par-departement.csv", "x;CODGEO\n5;6\n")
    groups = [with_provenance(df) for df in read_groups(spark, list_files(spark, str(base)))]
    assert len(groups) == 2
    found = [row for df in groups for row in rows(df, "CODGEO", "x", "type", "annee")]
    assert sorted(found, key=str) == [
        ("1", "2", "niveau vie", 2017),
        ("3", "4", "niveau vie", 2018),
        ("6", "5", "ventes", None),
    ]


@pytest.mark.parametrize("max_bytes", [0, 10**6])
def test_names_with_special_characters(spark, tmp_path, monkeypatch, max_bytes):
    """Percent signs, blanks and apostrophes survive listing, conversion and reading back."""
    monkeypatch.setattr("armorica.sources.tree.BROADCAST_BYTES", max_bytes)
    names = ["100%25 a+b-par-commune", "niveau-d'étude-par-commune"]
    for name in names:
        write_workbook(str(tmp_path / "in" / "2017" / f"{name}.xlsx"), [("CODGEO", "x"), ("22050", name)])
        put(tmp_path / "in" / "2018" / f"{name}.csv", f"CODGEO;x\n22050;{name}\n")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for turn, table in enumerate(yearly_tables(spark, source)):
        write_delimited(table, target, ["source_file", "year_folder"], mode="append" if turn else "overwrite")
    for base in (source, target):
        files = list_files(spark, base)
        assert {file.name.rpartition(".")[0] for file in files} == set(names)
        found = [row for df in read_groups(spark, files) for row in rows(with_provenance(df), "x", "type", "annee")]
        types = {name: name.removesuffix("-par-commune").replace("-", " ") for name in names}
        expected = [(name, types[name], year) for name in names for year in (2017, 2018)]
        kinds = [(x, kind.removesuffix(".xlsx").removesuffix("par commune").strip(), year) for x, kind, year in found]
        assert sorted(kinds) == sorted(expected)


# -- sinks -------------------------------------------------------------------


def test_written_rows_are_counted(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("annee"))
    assert write_delimited(df, str(tmp_path / "x.csv"), partition_by=["annee"], compact=True) == 1000
    folders = sorted(name for name in os.listdir(tmp_path / "x.csv") if name.startswith("annee"))
    assert folders == ["annee=0", "annee=1", "annee=2"]
    for folder in folders:
        assert len([n for n in os.listdir(tmp_path / "x.csv" / folder) if n.startswith("part")]) == 1


def test_small_result_is_one_file(spark, tmp_path):
    write_delimited(spark.range(0, 1000, 1, 8), str(tmp_path / "x.csv"), compact=True)
    assert len([n for n in os.listdir(tmp_path / "x.csv") if n.startswith("part")]) == 1


def test_hot_value_is_split(spark, settings, tmp_path):
    settings(
        adaptive__advisoryPartitionSizeInBytes="64k",
        adaptive__coalescePartitions__minPartitionSize="32k",
        files__maxPartitionBytes="256k",
    )
    df = spark.range(0, 200_000, 1, 16).select("id", F.when(F.col("id") % 10 < 9, 2017).otherwise(2018).alias("annee"))
    write_delimited(df, str(tmp_path / "x.csv"), partition_by=["annee"], compact=True)

    def parts(year):
        return len([n for n in os.listdir(tmp_path / "x.csv" / f"annee={year}") if n.startswith("part")])

    assert parts(2017) > 3
    assert read_file(spark, str(tmp_path / "x.csv")).count() == 200_000


def test_empty_results_are_written_and_counted(spark, tmp_path):
    empty = spark.range(10).filter("id > 100").withColumn("annee", F.lit(1))
    assert write_delimited(empty.limit(0), str(tmp_path / "a")) == 0
    assert write_delimited(empty, str(tmp_path / "b"), ["annee"], compact=True) == 0
    assert write_delimited(empty.groupBy("annee").count(), str(tmp_path / "c")) == 0


def test_counted(spark, tmp_path):
    df, seen = counted(spark.range(7))
    df.write.parquet(str(tmp_path / "x"))
    assert seen.get == {"n": 7}


def fact(spark, *values):
    schema = f"`{v.COMMUNE_CODE}` string, `{v.COMMUNE_LABEL}` string, `{v.DEPARTMENT}` int, annee int, type string, data string"
    return spark.createDataFrame(list(values), schema)


def test_facts_replace_their_own_parts(spark, tmp_path):
    path = str(tmp_path / "facts")
    assert rows(read_facts(spark, path)) == []
    write_facts(fact(spark, ("1", "a", 22, 2017, "x y", "{}"), ("1", "a", 22, 2018, "x y", "{}"), ("1", "a", 22, None, "z", "{}")), path)
    write_facts(fact(spark, ("2", "b", 22, 2018, "x y", "{}")), path)
    assert rows(read_facts(spark, path), v.COMMUNE_CODE, v.YEAR, v.TYPE) == [("1", 2017, "x y"), ("1", None, "z"), ("2", 2018, "x y")]


def test_ensure_table_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    ensure_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 0
    spark.range(2).write.mode("append").parquet(path)
    ensure_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 2


class Recorder:
    """Stands for a reader or writer and keeps what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def load(self):
        return self.told

    def save(self):
        self.told["saved"] = True


def test_database_options(monkeypatch):
    class Session:
        read = Recorder()

    told = read_database(Session(), "jdbc:x", "Commune", {"user": "u"}, split=("code_dep", 1, 95, 4))
    assert told == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "Commune",
        "user": "u",
        "partitionColumn": "code_dep",
        "lowerBound": "1",
        "upperBound": "95",
        "numPartitions": "4",
    }

    class Seen:
        get = {"n": 3}

    class Frame:
        write = Recorder()

    monkeypatch.setattr("armorica.sinks.database.counted", lambda df: (df, Seen))
    assert overwrite_database(Frame(), "jdbc:x", "Commune", v.COMMUNE_DDL, {"user": "u"}) == 3
    assert Frame.write.told["createTableColumnTypes"] == v.COMMUNE_DDL and Frame.write.told["mode"] == "overwrite"
    Frame.write = Recorder()
    assert append_database(Frame(), "jdbc:x", "Donnees_commune") == 3
    assert Frame.write.told == {"format": "jdbc", "mode": "append", "url": "jdbc:x", "dbtable": "Donnees_commune", "saved": True}


def test_publish_names_tables_and_types(spark, tmp_path, monkeypatch):
    geography = spark.createDataFrame(
        [("22050", "Dinan", "p", "22", "Côtes-d'Armor")],
        [v.COMMUNE_CODE, v.GEO_COMMUNE_LABEL, v.GEO_POINT, v.DEPARTMENT, v.GEO_DEPARTMENT_LABEL],
    )
    load_dimensions(geography, str(tmp_path))
    write_facts(fact(spark, ("22050", "Dinan", 22, 2017, "x", "{}")), str(tmp_path / v.FACT_TABLE))
    calls = []
    monkeypatch.setattr("armorica.sinks.database._write", lambda df, *rest: calls.append((df.columns, *rest)) or df.count())
    assert publish(spark, str(tmp_path), "jdbc:x", {"user": "u"}) == {v.DEPARTMENT_TABLE: 1, v.COMMUNE_TABLE: 1, v.FACT_TABLE: 1}
    assert [(call[2], call[3], call[4].get("createTableColumnTypes")) for call in calls] == [
        (v.DEPARTMENT_TABLE, "overwrite", v.DEPARTMENT_DDL),
        (v.COMMUNE_TABLE, "overwrite", v.COMMUNE_DDL),
        (v.FACT_TABLE, "append", None),
    ]
    assert calls[2][0] == [v.COMMUNE_CODE, v.COMMUNE_LABEL, v.DEPARTMENT, v.YEAR, v.TYPE, v.DATA]


# -- workspace -----------------------------------------------------------------


def test_shared_folder_is_the_session_setting(spark, settings, tmp_path):
    folder = shared_folder(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or folder == configured.rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert materialise(spark.range(5)).count() == 5


# -- plans -------------------------------------------------------------------------


CANDIDATES = ("Nuance candidat 1", "% Voix/exprimés 1", "Nuance candidat 2", "% Voix/exprimés 2")


@pytest.fixture
def inputs(tmp_path):
    base = tmp_path / "inputs"
    elections = base / v.ELECTIONS
    for year, camps in ((2017, "FI,x,Gauche\nRN,x,Droite\n"), (2022, "FI,x,Gauche\nRN,x,\n")):
        put(elections / str(year) / v.REFERENCE_FILE, "Code,Nuance,Orientation\n" + camps)
        header = ("Code département", "Libellé du département", "Inscrits", *CANDIDATES)
        write_workbook(
            str(elections / str(year) / "resultats-par-departement.xlsx"),
            [header, (22.0, "Côtes-d'Armor", 9, "FI", "40,5%", "RN", "50%"), (75.0, "Paris", 9, "FI", "1%", "RN", "2%")],
        )
    for dataset in v.YEARLY_DATASETS:
        put(base / dataset / "2022" / f"{dataset}-par-commune.csv", "CODGEO;loyer\n22050.0;9.5\n75056;20\n1004;7\n")
    write_workbook(
        str(base / "Pauvrete/2017" / f"{v.POVERTY_FILE}.xlsx"),
        [("CODGEO", "LIBGEO", v.POVERTY_METRIC), (22050, "Dinan", 27.5), (22050, "Dinan", 28), (75056, "Paris", 9)],
    )
    put(
        base / "Demographie-NiveauEtude/2022" / f"{v.EDUCATION_FILE}.csv",
        "CODGEO;LIBGEO;dpx_rec1_rec1rpop2021;dpx_rec6_rec1rpop2021;dpx_rec2_rec2rpop2021\n22050;Dinan;30.0;10;60\n",
    )
    write_workbook(
        str(base / "Security" / f"{v.CRIME_FILE}.xlsx"),
        [
            (v.REGION, v.YEAR, v.INDICATOR, v.UNIT, v.RATE),
            (53, 2017, "Vols", "Victime", 9.5),
            (53, 2022, "Vols", "Victime", 10.25),
            (53, 2019, "Vols", "Victime", 99),
            (11, 2017, "Vols", "Victime", 50),
        ],
    )
    write_workbook(
        str(base / "IndicePositionSociale" / f"{v.SOCIAL_FILE}.xlsx"),
        [
            ("CODGEO", "LIBGEO", v.YEAR, v.SOCIAL_METRIC),
            ("22050", "DINAN", "2019-2020", 110),
            ("22050", "DINAN", "2019-2020", 111),
            ("22050", "DINAN", "2020-2021", 1099.5),
        ],
    )
    write_workbook(
        str(base / v.READY_INPUT / "chomage-par-departement.xlsx"),
        [("Libellé département", "Code Département", "Taux de chômage (en %) 2017", "Taux de chômage (en %) 2022"), ("Côtes-d'Armor", 22.0, 8.5, None)],
    )
    put(base / v.READY_INPUT / "ignored.csv", "x\n1\n")
    put(
        base / v.GEOGRAPHY_FILE,
        "CODGEO;Libellé Commune;Geo Point;Code département;Libellé département\n"
        "22050;Dinan;48, -2;22;Côtes-d'Armor\n22113;Lannion;48, -3;22;Côtes-d'Armor\n29019;Brest;48, -4;29;Finistère\n",
    )
    return base


def test_everything(spark, inputs, tmp_path):
    outputs, store, exports = (str(tmp_path / name) for name in ("outputs", "store", "exports"))
    done = run_all(spark, str(inputs), outputs, store, exports)

    assert done["elections"] == 2
    scores = read_delimited(spark, f"{outputs}/{v.ELECTIONS}")
    assert rows(scores, v.DEPARTMENT, v.YEAR, v.SCORE_LEFT, v.SCORE_RIGHT, v.SCORE_OTHER) == [
        ("22", 2017, "40.5", "50.0", "9.5"),
        ("22", 2022, "40.5", "0.0", "59.5"),
    ]
    assert done["yearly"] == 3
    rent = read_delimited(spark, f"{outputs}/CarteLoyer")
    assert rows(rent, v.COMMUNE_CODE, "loyer", v.DEPARTMENT, v.COMMUNE_PART, "year_folder") == [("22050", "9.5", "22", "050", 2022)]
    assert rows(read_file(spark, f"{outputs}/Pauvrete/2017/{v.POVERTY_FILE}.csv")) == [("22050", "Dinan", "27.75")]
    shares = read_file(spark, f"{outputs}/Demographie-NiveauEtude/2022/{v.EDUCATION_OUTPUT}.csv")
    assert rows(shares) == [("22050", "22", "050", "Dinan", "100", "10.0", "90.0", "25.0", "75.0", "0.0", "100.0")]
    crime = read_file(spark, f"{outputs}/Security/{v.CRIME_FILE}.csv")
    assert rows(crime) == [("53", "Vols", "Victime", "9.5", "10.25", None)]
    social = read_file(spark, f"{outputs}/IndicePositionSociale/{v.SOCIAL_FILE}.csv")
    assert rows(social) == [("22050", "DINAN", "1,099.50", 2020), ("22050", "DINAN", "110.50", 2019)]
    ready = read_delimited(spark, f"{outputs}/{v.READY_OUTPUT}")
    assert rows(ready, v.DEPARTMENT, "source_file") == [("22", "chomage-par-departement.csv")]

    assert done["dimensions"] == {v.DEPARTMENT_TABLE: 2, v.COMMUNE_TABLE: 3}
    facts = read_facts(spark, f"{store}/{v.FACT_TABLE}")
    assert done["facts"] == facts.count()
    counts = {tuple(row) for row in facts.groupBy(v.TYPE, v.YEAR).count().collect()}
    assert counts == {
        ("resultats", 2017, 2),
        ("resultats", 2022, 2),
        *[(name, 2022, 1) for name in v.YEARLY_DATASETS],
        ("niveau pauvrete", 2017, 1),
        ("population niveau etude", 2022, 1),
        ("indice position sociale lycee", 2019, 1),
        ("indice position sociale lycee", 2020, 1),
        ("criminalite", 2017, 2 + 1),
        ("criminalite", 2022, 2 + 1),
        ("criminalite", 2024, 2 + 1),
        ("chomage", 2017, 2),
        ("chomage", 2022, 2),
    }
    assert set(done["violations"].values()) == {0}
    assert done["exports"]["niveau pauvrete"] == 1
    flat = read_delimited(spark, f"{exports}/niveau pauvrete.csv")
    assert rows(flat, v.COMMUNE_CODE, v.COMMUNE_LABEL, v.DEPARTMENT, v.YEAR, v.TYPE, "geo_point", v.POVERTY_MEAN) == [
        ("22050", "Dinan", "22", 2017, "niveau pauvrete", "48, -2", "27.75")
    ]
    crime = read_delimited(spark, f"{exports}/criminalite.csv").filter("annee = 2022")
    assert rows(crime, v.COMMUNE_CODE, "indicateur", "typemetric", "valeur")[0] == ("22050", "Vols", "taux pour mille", "10.25")

    # A second load replaces the facts instead of doubling them.
    assert load_facts(spark, outputs, store) == done["facts"]
    assert read_facts(spark, f"{store}/{v.FACT_TABLE}").count() == done["facts"]
    broken = check_warehouse(spark, store)
    assert {name: df.count() for name, df in broken.items()} == done["violations"]


def test_nothing_to_do(spark, tmp_path):
    places = [str(tmp_path / name) for name in ("inputs", "outputs", "store", "exports")]
    done = run_all(spark, *places)
    assert not any(done.values())
    put(tmp_path / "inputs" / v.GEOGRAPHY_FILE, "CODGEO;Libellé Commune;Geo Point;Code département;Libellé département\n")
    done = run_all(spark, *places)
    assert done["facts"] == 0 and done["exports"] == {} and not any(done["violations"].values())


def test_checks_find_what_is_broken(spark, tmp_path):
    dimension = "code_com string, nom_com string, geo_point string, code_dep int"
    communes = [("22050", "Dinan", "p", 22), ("22050", "Dinan", "p", 22), ("75056", "Paris", "p", 75)]
    spark.createDataFrame(communes, dimension).write.parquet(str(tmp_path / v.COMMUNE_TABLE))
    departments = [(22, "Côtes-d'Armor"), (None, "?")]
    spark.createDataFrame(departments, "code_dep int, nom_dep string").write.parquet(str(tmp_path / v.DEPARTMENT_TABLE))
    facts = fact(
        spark, ("22050", "Dinan", 22, 2017, "a", "{}"), ("999999", "?", 99, 2017, "a", "{bad"), (None, "?", None, 2017, "b", None)
    )
    write_facts(facts, str(tmp_path / v.FACT_TABLE))
    broken = {name: rows(df) for name, df in check_warehouse(spark, str(tmp_path)).items()}
    assert broken == {
        "department key": [(None, 1)],
        "commune key": [("22050", 2)],
        "commune in department": [(75, 1)],
        "fact in commune": [("999999", 1)],
        "fact in department": [(99, 1)],
        "fact types": [(v.COMMUNE_CODE, 2), (v.DEPARTMENT, 1)],
        "fact data": [("a", 1)],
    }


def test_missing_inputs_are_skipped(spark, inputs, tmp_path):
    assert average_poverty(spark, str(tmp_path / "none.xlsx"), str(tmp_path / "out")) is None
    assert not os.path.exists(tmp_path / "out")


def test_year_without_reference_is_refused(spark, inputs):
    put(inputs / v.ELECTIONS / "2024" / "resultats.csv", "Code département\n22\n")
    with pytest.raises(ValueError, match="2024"):
        election_scores(spark, str(inputs / v.ELECTIONS))


def test_convert_tree_takes_workbooks_only(spark, inputs, tmp_path):
    assert convert_tree(spark, str(inputs / v.READY_INPUT), str(tmp_path / "out")) == 1


def test_files_of_one_name_stay_apart(spark, tmp_path):
    """Workbooks of equal name, from folders with odd names, one of them a year."""
    names = ["a b%2Fc", "d", "2017"]
    for name in names:
        write_workbook(str(tmp_path / "in" / name / "x-par-commune.xlsx"), [("CODGEO", "x"), ("22050", name)])
    target = str(tmp_path / "out")
    assert convert_tree(spark, str(tmp_path / "in"), target) == 3
    files = list_files(spark, target)
    assert sorted(file.name for file in files) == ["a b%2Fc/x-par-commune.csv", "d/x-par-commune.csv", "x-par-commune.csv"]
    found = [row for df in read_groups(spark, files) for row in rows(with_provenance(df), "x", "type", "annee")]
    assert sorted(found, key=str) == [("2017", "x", 2017), ("a b%2Fc", "x", None), ("d", "x", None)]


def test_metric_files_that_fit_no_plan_are_left_out(spark, tmp_path):
    put(tmp_path / "o" / "a-par-departement.csv", "Code département;x\n22;1\n")
    put(tmp_path / "o" / "b-par-region.csv", "Code région;indicateur;x 2017\n53;i;1\n")
    put(tmp_path / "o" / "2017" / "c-par-departements.csv", "Code département;x 2017\n22;1\n")
    assert metric_tables(spark, str(tmp_path / "o")) == []
    put(tmp_path / "o" / "2017" / "d-par-departement.csv", "Code département;x 2022\n22;1\n")
    tables = metric_tables(spark, str(tmp_path / "o"))
    assert [rows(df, v.YEAR, v.TYPE) for df in tables] == [[(2017, "d")], [(2022, "d")]]


def test_malformed_files_fail_loudly(spark, tmp_path):
    put(tmp_path / "broken.xlsx", "no zip")
    with pytest.raises(PySparkException):
        read_file(spark, str(tmp_path / "broken.xlsx"))


def test_facts_are_replaced_or_added(spark, tmp_path):
    from armorica.sinks import read_facts, write_facts
    from armorica.sinks.warehouse import FACT_SCHEMA

    def one(code):
        return spark.createDataFrame([(code, "x", 22, "{}", "t", 2017)], FACT_SCHEMA).selectExpr("*")

    path = str(tmp_path / "fact")
    write_facts(one("a"), path)
    write_facts(one("b"), path, mode="append")
    assert sorted(row[0] for row in read_facts(spark, path).collect()) == ["a", "b"]
    write_facts(one("c"), path)
    assert [row[0] for row in read_facts(spark, path).collect()] == ["c"]


def test_rows_without_a_year_reach_the_facts(spark, tmp_path):
    from armorica.plans.warehouse import metric_tables

    base = tmp_path / "outputs" / "d" / "x-par-commune.csv"
    put(base / "annee=2017" / "part-0.csv", "Code Commune;n\n22050;1\n")
    put(base / "annee=__HIVE_DEFAULT_PARTITION__" / "part-0.csv", "Code Commune;n\n22113;2\n")
    found = [(row["n"], row[v.YEAR]) for table in metric_tables(spark, str(tmp_path / "outputs")) for row in table.collect()]
    assert sorted(found) == [("1", 2017), ("2", None)]


def test_camp_of_mixed_case(spark):
    from armorica.operators.scores import camp_lookup

    rows_in = [("1", "Gauche"), ("1", "droite"), ("2", "gauche"), ("2", "Droite")]
    reference = spark.createDataFrame(rows_in, f"`{v.REFERENCE_CODE}` string, `{v.REFERENCE_CAMP}` string")
    assert {row["camp"] for row in camp_lookup(reference).collect()} == {"gauche"}


def test_separator_follows_the_file_name():
    from armorica.sources.delimited import separator_for

    stem = v.REFERENCE_FILE.removesuffix(".csv")
    assert separator_for(f"/a/{stem}.csv") == "," and separator_for(f"/{stem}/other.csv") == ";"
