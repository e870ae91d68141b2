"""Files written to the shared folder and read back: splits, provenance, workbooks, stored facts."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from functools import partial, reduce
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.operators import facts as fact_operators
from armorica.operators.cleaning import empty
from armorica.operators.facts import communes
from armorica.plans import convert_tree, export_facts
from armorica.queries.facts import FACT_SQL, geography, order_metrics
from armorica.queries.registry import query, table
from armorica.sinks import ensure_table, read_facts, write_delimited, write_facts, write_table
from armorica.sources import file_tree, read_delimited, read_file, read_workbooks
from armorica.sources.tree import read_labelled, with_provenance
from armorica.workspace import new_folder


@query(
    """
select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment, cast(c_nationkey as varchar) as c_nationkey
from customer"""
)
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Every column comes back as text."""
    path = new_folder(spark, "csv") + "/clients.csv"
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    write_delimited(rows, path)
    return read_file(spark, path)


@query(
    """
select cast(o_orderkey as varchar) as o_orderkey, cast(year(o_orderdate) as integer) as annee from orders"""
)
def split_by_year_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "split") + "/commandes.csv"
    rows = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias(v.YEAR))
    write_delimited(rows, path, partition_by=[v.YEAR], compact=True)
    return read_file(spark, path)


@query(
    """
select case when o_orderpriority <> '5-LOW' then cast(year(o_orderdate) as integer) end as annee, count(*) as n
from orders group by all"""
)
def split_null_year(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a year keep a folder of their own."""
    path = new_folder(spark, "split") + "/commandes.csv"
    year = F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate"))
    rows = table(spark, folder, "orders").select("o_orderkey", year.alias(v.YEAR))
    write_delimited(rows, path, partition_by=[v.YEAR], compact=True)
    return read_file(spark, path).groupBy(v.YEAR).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
select cast(o_orderkey as varchar) as key, cast(year(o_orderdate) as integer) as annee, 'commandes client' as type,
  o_orderstatus as status, null as segment from orders
union all
select cast(c_custkey as varchar) as key, 2017 as annee, 'clients' as type, null as status, c_mktsegment as segment
from customer"""
)
def tree_provenance(spark: SparkSession, folder: str) -> DataFrame:
    """Files of two headers in one tree, their type and year taken from the path."""
    base = new_folder(spark, "tree")
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    write_delimited(
        orders.select(
            F.col("o_orderkey").alias("key"),
            F.col("o_orderstatus").alias("status"),
            F.year("o_orderdate").alias(v.YEAR),
        ),
        f"{base}/ventes/commandes-client-par-commune.csv",
        partition_by=[v.YEAR],
    )
    write_delimited(
        customers.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment")),
        f"{base}/clients/2017/clients-par-departement.csv",
    )
    groups = [with_provenance(group.table, group) for group in read_labelled(spark, file_tree(spark, base), {"": F.lit(True)})]
    return groups[0].unionByName(groups[1], allowMissingColumns=True)


@query(
    """
select cast(p_partkey as bigint) as "Code", p_name as "Libellé",
  case when p_type <> 'SMALL' then p_type end as "Type & co", cast(p_size as bigint) as "Taille"
from part"""
)
def workbook_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Parts written to workbooks of a thousand rows each, and read again with the types of their cells."""
    parts = table(spark, folder, "part").select(
        "p_partkey",
        "p_name",
        F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("p_type"),
        "p_size",
    )
    return read_workbooks(spark, [write_workbooks(parts, "parts", HEADER)])[0]


@query(
    """
select c_custkey as "Code", 'client ' || c_custkey as "Libellé", lpad(cast(c_nationkey as varchar), 2, '0') as "Code département",
  case when c_nationkey % 2 = 0 then 'pairs' else 'impairs' end as folder from customer"""
)
def workbook_conversion(spark: SparkSession, folder: str) -> DataFrame:
    """Workbooks of two folders converted to delimited files, and read again."""
    base = new_folder(spark, "books")
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.concat_ws(" ", F.lit("client"), "c_custkey").alias("label"), "c_nationkey"
    )
    for turn, side in enumerate(("pairs", "impairs")):
        write_workbooks(customers.filter(F.col("c_nationkey") % 2 == turn), "clients", PLACED, f"{base}/in/{side}")
    convert_tree(spark, f"{base}/in", f"{base}/out")
    back = read_delimited(spark, f"{base}/out")
    return back.select(
        F.col("Code").cast("bigint").alias("Code"),
        "Libellé",
        F.lpad(f"`{v.DEPARTMENT}`", 2, "0").alias(v.DEPARTMENT),
        F.substring_index("source_file", "/", 1).alias("folder"),
    )


@query(
    """
select 'csv' as format, 'read' as outcome, count(*) as n from customer
union all select 'xlsx', 'read', count(*) from nation
union all select 'txt', 'unsupported', null
union all select 'xls', 'unsupported', null
union all select 'csv', 'absent', null
union all select 'xlsx', 'absent', null"""
)
def format_guard(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of files by format: those read with their rows, those not supported, those that are not there."""
    base = new_folder(spark, "formats")
    write_delimited(table(spark, folder, "customer").select("c_custkey", "c_name"), f"{base}/clients.csv")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    write_workbooks(nations.coalesce(1), "nations", ("Code", "Libellé"), base)
    paths = {"clients.csv": "csv", "nations-0-0.xlsx": "xlsx", "note.txt": "txt", "old.xls": "xls", "none.csv": "csv", "none.xlsx": "xlsx"}
    found = []
    for name, kind in paths.items():
        try:
            rows = read_file(spark, f"{base}/{name}")
        except ValueError:
            rows, outcome = None, "unsupported"
        else:
            outcome = "absent" if rows is None else "read"
        counted = (spark.range(1) if rows is None else rows).agg(F.count(F.lit(1)).alias("n"))
        n = F.col("n") if outcome == "read" else F.lit(None).cast("bigint")
        found.append(counted.select(F.lit(kind).alias("format"), F.lit(outcome).alias("outcome"), n.alias("n")))
    return reduce(DataFrame.unionByName, found)


HEADER = ("Code", "Libellé", "Type & co", "Taille")
PLACED = ("Code", "Libellé", "code département")
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_workbooks(rows: DataFrame, name: str, header: Sequence[str], folder: str | None = None) -> str:
    """Workbooks of a thousand rows each, written by the tasks; gives their folder.

    The files of a task are named by its number, so that of a repeated task one copy stays.
    """
    folder = folder or new_folder(rows.sparkSession, name)
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    rows.mapInPandas(partial(_workbooks, f"{folder}/{name}", header), "path string").write.format("noop").mode("overwrite").save()
    return folder


def _workbooks(base: str, header: Sequence[str], batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    store, path = fs.FileSystem.from_uri(base)
    turn, task = 0, TaskContext.get().partitionId()
    for batch in batches:
        for start in range(0, len(batch), 1000):
            place = f"{path}-{task}-{turn}.xlsx"
            with store.open_output_stream(place) as file:
                file.write(_workbook(header, batch.iloc[start : start + 1000]))
            turn += 1
            yield pd.DataFrame({"path": [place]})


def _workbook(header: Sequence[str], rows: pd.DataFrame) -> bytes:
    """One workbook of the given rows; numbers as numbers, text inline, null as no cell."""

    def cell(place: str, value: object) -> str:
        if value is None or value != value:
            return ""
        if isinstance(value, str):
            return f'<c r="{place}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        return f'<c r="{place}"><v>{value}</v></c>'

    lines = [tuple(header), *rows.itertuples(index=False, name=None)]
    body = "".join(
        f'<row r="{n}">' + "".join(cell(f"{letter}{n}", value) for letter, value in zip("ABCD", line)) + "</row>"
        for n, line in enumerate(lines, start=1)
    )
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    relation = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{relation}"><sheets>'
            '<sheet name="Feuille" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{package}">'
            '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        sheet = f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
        book.writestr("xl/worksheets/sheet1.xml", sheet)
    return buffer.getvalue()


@query("select cast(c_custkey as varchar) as code_com, c_name as nom_com, c_nationkey as code_dep from customer")
def dimension_stored(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "dimension")
    write_table(communes(geography(spark, folder)).drop("geo_point"), path)
    return spark.read.parquet(path)


@query("select cast(c_custkey as varchar) as code_com, c_name as nom_com, c_nationkey as code_dep from customer")
def table_ensured(spark: SparkSession, folder: str) -> DataFrame:
    """Created empty where there is none, left as it is where there is one."""
    path = new_folder(spark, "ensured")
    rows = communes(geography(spark, folder)).drop("geo_point")
    ensure_table(rows, path)
    rows.write.mode("append").parquet(path)
    ensure_table(rows, path)
    return spark.read.parquet(path)


@query(FACT_SQL)
def facts_gated(spark: SparkSession, folder: str) -> DataFrame:
    """A table without a type makes no facts, nor does one without rows."""
    metrics, places = order_metrics(spark, folder), communes(geography(spark, folder))
    tables = [metrics, metrics.drop(v.TYPE), empty(metrics)]
    found = [fact_operators.facts(one, places) for one in tables]
    return reduce(DataFrame.unionByName, [one for one in found if one is not None])


@query(FACT_SQL)
def facts_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Loaded twice: the second load replaces the first."""
    path = new_folder(spark, "facts")
    rows = fact_operators.facts(order_metrics(spark, folder), communes(geography(spark, folder)))
    write_facts(rows, path)
    write_facts(rows, path)
    return read_facts(spark, path)


@query(
    """
select cast(c_custkey as varchar) as "CODGEO", c_name as "LIBGEO", cast(c_nationkey as varchar) as "Code département",
  cast(year(o_orderdate) as integer) as annee, 'commandes' as type, cast(o_orderkey as varchar) as o_orderkey,
  case when o_orderstatus <> 'P' then o_orderstatus end as status, cast(c_custkey as varchar) as code_com,
  c_name as nom_com, c_mktsegment as geo_point, cast(c_nationkey as varchar) as code_dep
from orders join customer on o_custkey = c_custkey"""
)
def facts_exported(spark: SparkSession, folder: str) -> DataFrame:
    """Facts stored, flattened by type and year, and read back from the delimited files."""
    base = new_folder(spark, "export")
    rows = fact_operators.facts(order_metrics(spark, folder), communes(geography(spark, folder)))
    write_facts(rows, f"{base}/store/{v.FACT_TABLE}")
    export_facts(spark, f"{base}/store", f"{base}/exports")
    return read_delimited(spark, f"{base}/exports/commandes.csv")
