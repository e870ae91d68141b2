"""Trees of many files: what reaches the driver, what is read of a file, stores only Spark opens, jobs run together."""

from __future__ import annotations

import io
import os
import threading
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from workbooks import write_workbook

from armorica import vocabulary as v
from armorica.concurrency import attempt_together, run_together
from armorica.plans import export_facts
from armorica.plans import warehouse as warehouse_plans
from armorica.plans.warehouse import ExportFailed, check_facts
from armorica.sinks import write_facts
from armorica.sinks.warehouse import FACT_SCHEMA
from armorica.sources import file_tree, read_groups, read_workbooks
from armorica.sources import tree as trees
from armorica.sources import workbook as workbooks_module
from armorica.sources.delimited import header_schema
from armorica.sources.store import BLOCK_BYTES, Unreadable, first_line, open_path
from armorica.sources.tree import with_provenance


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as file:
        file.write(text)


class Counted(io.BytesIO):
    taken = 0

    def read(self, size=-1):
        data = super().read(size)
        self.taken += len(data)
        return data


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_only_the_first_line_is_read(end):
    file = Counted(("﻿" + end + "  " + end + "Code;é" + end + "1;2" + end * 2_000_000).encode())
    assert first_line(file) == "Code;é"
    assert file.taken <= 64 << 10 and file.taken == BLOCK_BYTES
    long = ";".join(f"column {i}" for i in range(20_000))
    file = Counted((long + end + "1" * 10_000_000).encode())
    assert first_line(file) == long and file.taken < len(long) + 2 * BLOCK_BYTES
    assert first_line(Counted(b"")) is None and first_line(Counted(b"no end")) == "no end"


def test_paths_are_opened_as_spark_lists_them(tmp_path):
    path = str(tmp_path / "a b%20+é.csv")
    put(path, "x")
    for spelt in (path, f"file:{path}", f"file://{path}"):
        with open_path(spelt) as file:
            assert file.read() == b"x"
    with pytest.raises(Unreadable):
        open_path("viewfs://store/a.csv")
    with pytest.raises(FileNotFoundError):
        open_path(path + "x")


def test_header_columns():
    assert header_schema("Code;Taux  %").names == ["Code", "Taux  %"]
    for odd in (None, "", "a;;b", "a;A", '"a\\;b";c', "a\\;b"):
        assert header_schema(odd) is None


def test_a_folder_of_one_header_is_one_path(spark, tmp_path):
    for i in range(600):
        put(tmp_path / "2017" / f"x{i}-par-commune.csv", f"CODGEO;x\n{i};1\n")
    put(tmp_path / "2018" / "y-par-commune.csv", "CODGEO;x\n1;2\n")
    found = trees._by_header(spark, file_tree(spark, str(tmp_path)), {"": F.lit(True)}, True)
    assert [len(paths) for paths, _ in found.values()] == [2], "a pattern and a file"
    (group,) = trees.read_labelled(spark, file_tree(spark, str(tmp_path)), {"": F.lit(True)})
    counted = with_provenance(group.table, group).groupBy(v.YEAR).count().collect()
    assert sorted(tuple(row) for row in counted) == [(2017, 600), (2018, 1)]


def test_folders_that_hold_several_kinds(spark, tmp_path):
    """Headers, unchosen files, and a folder that goes by the name of a file, side by side."""
    for i in range(3):
        put(tmp_path / f"a{i}.csv", f"x;y\n{i};1\n")
        put(tmp_path / f"b{i}.csv", f"z\n{i}\n")
    put(tmp_path / "other.csv", "x;y\n9;9\n")
    put(tmp_path / "parts.csv" / "part-0.csv", "x;y\n7;1\n")
    put(tmp_path / "parts.csv" / "part-1.csv", "x;y\n8;1\n")
    put(tmp_path / "ReferenceDroiteGauche.csv", "x;y\n1\n")
    tree = file_tree(spark, str(tmp_path))

    def values(groups, column):
        return sorted(row[0] for df in groups for row in df.select(column).collect() if column in df.columns)

    chosen = tree.where(F.col("name").rlike("^[ab]"))
    groups = {tuple(df.columns): df for df in read_groups(spark, chosen)}
    assert values([groups["x", "y", "_source_path"]], "x") == ["0", "1", "2"]
    assert values([groups["z", "_source_path"]], "z") == ["0", "1", "2"]
    everything = {tuple(df.columns): df for df in read_groups(spark, tree)}
    assert values([everything["x", "y", "_source_path"]], "x") == ["0", "1", "2", "7", "8", "9"]
    assert "x;y" in {name for names in everything for name in names}, "a reference has another separator"
    labels = {"a": F.col("name").startswith("a"), "all": F.lit(True)}
    by_label = [(group.label, group.table.count()) for group in trees.read_labelled(spark, tree, labels) if "x" in group.table.columns]
    assert sorted(by_label) == [("a", 3), ("all", 6)]


def test_stores_that_only_spark_opens(spark, tmp_path, monkeypatch):
    def closed(batches):
        for batch in batches:
            at = batch.schema.get_field_index("readable")
            yield batch.set_column(at, "readable", pa.array([not wanted.as_py() for wanted in batch.column("wanted")]))

    def no_book(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield workbooks_module._batch("-", [(path, workbooks_module.CLOSED, None, None)])

    monkeypatch.setattr(trees, "add_first_lines", closed)
    monkeypatch.setattr(workbooks_module, "_parse_paths", no_book)
    put(tmp_path / "a b.csv", "x;y\n1;2\n")
    put(tmp_path / "c.csv", "y;x\n3;4\n")
    write_workbook(str(tmp_path / "d.xlsx"), [("x",), ("5",)])
    found = sorted(row["x"] for df in read_groups(spark, file_tree(spark, str(tmp_path))) for row in df.collect())
    assert found == ["1", "4", "5"]


def test_workbook_types_are_merged_over_books(spark, tmp_path):
    header = ("whole", "number", "mixed", "none", "text", "long")
    write_workbook(str(tmp_path / "a.xlsx"), [header, (1, 2, 3, None, "04", 1), (5, None, "x", None, "y", 12345678901234567890)])
    write_workbook(str(tmp_path / "b.xlsx"), [header, (-7, 2.5, 1, None, "z")])
    (table,) = read_workbooks(spark, [str(tmp_path)])
    assert dict(table.dtypes) == {
        "whole": "bigint", "number": "double", "mixed": "string", "none": "string", "text": "string", "long": "double"
    }
    assert sorted(tuple(row)[:5] for row in table.collect()) == [(-7, 2.5, "1", None, "z"), (1, 2.0, "3", None, "04"), (5, None, "x", None, "y")]
    (text,) = read_workbooks(spark, [str(tmp_path)], typed=False)
    assert {kind for _, kind in text.dtypes} == {"string"}


def test_true_and_false_cells(spark, tmp_path):
    from xml.etree import ElementTree

    cell = ElementTree.fromstring(f'<c xmlns="{workbooks_module.MAIN[1:-1]}" t="b"><v>1</v></c>')
    assert workbooks_module._kind(cell, "true") == workbooks_module.BOOLEAN
    rows = spark.createDataFrame([(1, ["true"]), (2, ["false"]), (3, [])], "position int, cells array<string>")
    table = workbooks_module.sheet_table(rows, ["flag"], kinds={0: workbooks_module.BOOLEAN})
    assert [row.flag for row in table.collect()] == [True, False, None]


def test_each_workbook_is_opened_once(spark, tmp_path):
    names = [f"{i}.xlsx" for i in range(4)]
    for name in names:
        write_workbook(str(tmp_path / name), [("x",), (1,), (2,)])
    (table,) = read_workbooks(spark, [str(tmp_path)])
    for name in names:  # read before: gone files are not missed
        put(tmp_path / name, "no workbook any more")
    assert table.count() == 8


def test_strings_in_one_piece():
    strings = workbooks_module.Strings()
    texts = ["", "é", "x" * 1000, "\U0001f642"]
    for text in texts:
        strings.append(text)
    assert [strings[i] for i in range(len(texts))] == texts


def test_facts_are_scanned_once_for_all_checks(spark, tmp_path):
    fact = spark.createDataFrame([("22050", "x", 22, "{}", "t", 2017), ("9", "x", 9, "{", "t", 2017)], FACT_SCHEMA)
    write_facts(fact, str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    places = spark.createDataFrame([("22050", 22)], "code_com string, code_dep int")
    found = check_facts(stored, places, places)
    for violations in found.values():
        assert str(tmp_path) not in violations._jdf.queryExecution().toString()
    assert {name: df.count() for name, df in found.items()} == {
        "fact in commune": 1, "fact in department": 1, "fact types": 0, "fact data": 1
    }


def test_a_type_that_fails_stops_no_other(spark, tmp_path, monkeypatch):
    fact = spark.createDataFrame([("1", "x", 1, '{"a": 1}', kind, 2017) for kind in ("p", "q", "r")], FACT_SCHEMA)
    write_facts(fact, str(tmp_path / v.FACT_TABLE))
    write = warehouse_plans.write_delimited

    def broken(df, path, **options):
        if path.endswith("q.csv"):
            raise OSError("no room")
        return write(df, path, **options)

    monkeypatch.setattr(warehouse_plans, "write_delimited", broken)
    with pytest.raises(ExportFailed, match="q: no room") as told:
        export_facts(spark, str(tmp_path), str(tmp_path / "out"))
    assert told.value.written == {"p": 1, "r": 1} and list(told.value.failed) == ["q"]
    assert sorted(os.listdir(tmp_path / "out")) == ["p.csv", "r.csv"]


def test_jobs_run_together(spark):
    meet = threading.Barrier(3, timeout=20)
    assert run_together(spark, {i: lambda: meet.wait() >= 0 for i in range(3)}, "t", at_once=3) == {0: True, 1: True, 2: True}

    def slow():
        spark.range(4).repartition(4).foreachPartition(lambda _: time.sleep(0.5))

    start = time.time()
    done, failed = attempt_together(spark, {"a": slow, "b": slow, "c": lambda: 1 / 0}, "t")
    assert time.time() - start < 8 and set(done) == {"a", "b"} and isinstance(failed["c"], ZeroDivisionError)
    with pytest.raises(ZeroDivisionError):
        run_together(spark, {"c": lambda: 1 / 0}, "t")


def test_only_changed_types_are_loaded_again(spark, tmp_path, monkeypatch):
    from armorica.sinks import read_facts, write_table

    outputs, store = tmp_path / "outputs", str(tmp_path / "store")
    places = spark.createDataFrame([("1", "x", "p", 22)], "code_com string, nom_com string, geo_point string, code_dep int")

    def metrics(name, year, value):
        put(outputs / str(year) / f"{name}-par-commune.csv", f"CODGEO;x\n1;{value}\n")

    def load():
        return warehouse_plans.load_facts(spark, str(outputs), store, changed_only=True)

    def stored():
        facts = read_facts(spark, f"{store}/{v.FACT_TABLE}")
        return sorted((row[v.TYPE], row[v.YEAR], row["x"]) for row in facts.selectExpr("type", "annee", "get_json_object(data, '$.x') as x").collect())

    write_table(places, f"{store}/{v.COMMUNE_TABLE}")
    for name, year in (("a", 2017), ("a", 2018), ("b", 2017)):
        metrics(name, year, 1)
    assert load() == 3
    read = []
    monkeypatch.setattr(trees, "read_delimited", lambda *rest, f=trees.read_delimited: read.append(rest[1]) or f(*rest))
    assert load() == 0 and not read, "no metric file is read"
    metrics("a", 2018, 22)
    assert load() == 2 and "b-par" not in str(read)
    assert stored() == [("a", 2017, "1"), ("a", 2018, "22"), ("b", 2017, "1")]
    metrics("c", 2020, 3)
    assert load() == 1
    write_table(places.withColumn("nom_com", F.lit("y")), f"{store}/{v.COMMUNE_TABLE}")
    assert load() == 4, "all, as the communes are new"
    with pytest.raises(ValueError):
        warehouse_plans.load_facts(spark, str(outputs), store, mode="append", changed_only=True)


def test_crowded_types_are_exported_as_rows(spark, tmp_path):
    fact = spark.createDataFrame(
        [("1", "x", 1, '{"a": 1, "b": 2, "c": 3}', "wide", 2017), ("1", "x", 1, '{"a": 4}', "slim", 2017)], FACT_SCHEMA
    )
    write_facts(fact, str(tmp_path / v.FACT_TABLE))
    assert export_facts(spark, str(tmp_path), str(tmp_path / "out"), most_columns=2) == {"wide": 3, "slim": 1}
    wide = spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "out" / "wide.csv"))
    assert sorted((row.metric, row.valeur) for row in wide.collect()) == [("a", "1"), ("b", "2"), ("c", "3")]


@pytest.mark.parametrize("parts", [1, 2, 7, 50])
def test_predicates_hold_for_every_value_once(spark, parts):
    from armorica.sources import quantile_predicates

    skewed = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.when(F.col("id") < 600, 5).otherwise(F.col("id") * 1000 - 500_000)).alias("code"))
    predicates = quantile_predicates(skewed.sample(0.5, seed=1), "code", parts)
    held = skewed.select(sum((F.coalesce(F.expr(one), F.lit(False)).cast("int") for one in predicates), F.lit(0)).alias("n"))
    assert held.distinct().collect() == [(1,)] and len(predicates) <= parts
    assert quantile_predicates(skewed.limit(0), "code", parts) == ["1 = 1"]
    sizes = [skewed.filter(one).count() for one in predicates]
    assert max(sizes) <= max(641, 2 * 1000 / parts), "all rows of one key stay in one part"


def test_even_reads_of_a_database(spark):
    from armorica.sources import database

    class Reader:
        told = {}

        def format(self, name):
            return self

        def options(self, **options):
            self.told["sample"] = options["dbtable"]
            return self

        def load(self):
            return spark.range(100).withColumnRenamed("id", "code")

        def jdbc(self, url, table, predicates, properties):
            self.told |= {"table": table, "predicates": predicates, "properties": properties}
            return "rows"

    class Session:
        read = Reader()

    assert database.read_database_evenly(Session(), "jdbc:x", "Commune", "code", 4, options={"user": "u"}) == "rows"
    told = Session.read.told
    assert told["sample"] == "(SELECT code FROM Commune) sampled_keys" and told["properties"] == {"user": "u"}
    assert len(told["predicates"]) == 4 and told["predicates"][0].endswith("IS NULL")
