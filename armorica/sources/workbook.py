"""Workbooks (.xlsx), first sheet, header in the first row.

Each workbook is opened once, by one task, and read as a stream: its rows, its header and
what kinds of cells each column holds go to the shared folder. Headers are grouped and kinds
merged in Spark; a table is a scan of the rows of its header.
"""

from __future__ import annotations

import hashlib
import io
import re
import sys
import zipfile
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from typing import BinaryIO
from urllib.parse import unquote
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica.sources.store import Unreadable, open_path
from armorica.workspace import new_folder

# Names given by the Office Open XML format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
WORKBOOK = "xl/workbook.xml"
RELATIONS = "xl/_rels/workbook.xml.rels"
SHARED_STRINGS = "xl/sharedStrings.xml"

# Rows of a sheet; position 0 is the header, LAST tells the kinds of all cells by column, CLOSED a book no task could open.
ROWS = "layout string, path string, position int, cells array<string>, kinds array<int>"
LAST, CLOSED = -1, -2
BATCH_ROWS = 5000
# Kinds of cells, one bit each, so that those of a column add up by "or".
BOOLEAN, WHOLE, NUMBER, TEXT = 1, 2, 4, 8

# Tasks get the code of this module with the plan, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_workbooks(
    spark: SparkSession, paths: Sequence[str], path_column: str | None = None, typed: bool = True
) -> list[DataFrame]:
    """The workbooks as one DataFrame per distinct header.

    ``paths``: files, folders or patterns. ``typed``: a column of cells that are all true or false,
    whole numbers (of at most 18 digits), or numbers, in all books of that header, is boolean,
    bigint or double; any other one, and one without cells, is text. Else every column is text.
    """
    books = spark.read.format("binaryFile").option("pathGlobFilter", "*.{xlsx,XLSX}").load(list(paths))
    listed = books.select(F.col("_metadata.file_path").alias("path"), F.col("path").alias("plain"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_folder(spark, "workbooks")
    listed.repartition(tasks, "plain").mapInArrow(_parse_paths, ROWS).write.partitionBy("layout").parquet(folder)
    schema = ROWS.removeprefix("layout string, ") + ", layout string"
    staged = spark.read.schema(schema).parquet(folder)
    closed = [unquote(row["path"]) for row in staged.filter(F.col("position") == CLOSED).select("path").collect()]
    if closed:
        # A store that only Spark opens: it hands over whole books.
        whole = spark.read.format("binaryFile").load(closed).select(F.col("_metadata.file_path").alias("path"), "content")
        whole.mapInArrow(_parse, ROWS).write.mode("append").partitionBy("layout").parquet(folder)
        staged = spark.read.schema(schema).parquet(folder)
    headers = staged.filter("position = 0").groupBy("layout").agg(F.any_value("cells").alias("cells"), F.min("path").alias("path"))
    kinds: dict[str, dict[int, int]] = defaultdict(dict)
    if typed:
        of_column = staged.filter(F.col("position") == LAST).select("layout", F.posexplode("kinds").alias("place", "kind"))
        for row in of_column.groupBy("layout", "place").agg(F.bit_or("kind").alias("kind")).collect():
            kinds[row["layout"]][row["place"]] = row["kind"]
    return [
        sheet_table(staged.filter(F.col("layout") == row["layout"]), row["cells"], path_column, kinds[row["layout"]])
        for row in sorted(headers.collect(), key=lambda row: row["path"])
    ]


def sheet_table(
    rows: DataFrame, header: Sequence[str | None], path_column: str | None = None, kinds: dict[int, int] | None = None
) -> DataFrame:
    """Rows of cells as columns named by the header, of the type their kinds allow.

    As in delimited files, a column without a name is called by its place, and
    of names that differ in case at most each gets its place added.
    """
    folded = [(name or "").casefold() for name in header]
    names = [f"_c{i}" if not name else f"{name}{i}" if folded.count(folded[i]) > 1 else name for i, name in enumerate(header)]
    cells = [_typed(F.try_element_at("cells", F.lit(i + 1)), (kinds or {}).get(i, TEXT)).alias(name) for i, name in enumerate(names)]
    if path_column:
        cells.append(F.col("path").alias(path_column))
    return rows.filter("position > 0").select(*cells)


def _typed(cell: Column, kinds: int) -> Column:
    """The least type for these kinds of cells."""
    if kinds == BOOLEAN:
        return cell.cast("boolean")
    if kinds == WHOLE:
        return cell.cast("bigint")
    if kinds in (NUMBER, WHOLE | NUMBER):
        return cell.cast("double")
    return cell


def _parse_paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the books at the paths, each opened once."""
    for batch in batches:
        for path, plain in zip(batch.column("path").to_pylist(), batch.column("plain").to_pylist(), strict=True):
            try:
                file = open_path(plain)
            except Unreadable:
                yield _batch("-", [(path, CLOSED, None, None)])
                continue
            with file:
                yield from _book(path, file)


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole books."""
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            yield from _book(path.as_py(), io.BytesIO(content.as_py()))


def _book(path: str, file: BinaryIO) -> Iterator[pa.RecordBatch]:
    """The rows of a book and, at last, the kinds of cells of each column."""
    layout, kinds, block = "", [], []
    for position, row in enumerate(_sheet(file)):
        cells = [text for text, _ in row]
        if position == 0:
            layout = hashlib.sha256(repr(cells).encode("utf-8", "replace")).hexdigest()[:32]
        else:
            kinds.extend([0] * (len(row) - len(kinds)))
            for place, (_, kind) in enumerate(row):
                kinds[place] |= kind
        block.append((path, position, cells, None))
        if len(block) == BATCH_ROWS:
            yield _batch(layout, block)
            block = []
    if layout:
        yield _batch(layout, [*block, (path, LAST, None, kinds)])


def _batch(layout: str, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    types = [pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32())]
    arrays = [pa.array([layout] * len(rows), pa.string())]
    arrays += [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["layout", "path", "position", "cells", "kinds"])


class Strings:
    """Texts by number, held as bytes in one piece."""

    def __init__(self) -> None:
        self._bytes = bytearray()
        self._ends = array("Q", [0])

    def append(self, text: str) -> None:
        self._bytes += text.encode("utf-8", "surrogatepass")
        self._ends.append(len(self._bytes))

    def __getitem__(self, number: int) -> str:
        return self._bytes[self._ends[number] : self._ends[number + 1]].decode("utf-8", "surrogatepass")


def _sheet(file: BinaryIO) -> Iterator[list[tuple[str | None, int]]]:
    """Text and kind of the cells of rows that hold a value, read as a stream."""
    with zipfile.ZipFile(file) as book:
        strings = Strings()
        if SHARED_STRINGS in book.namelist():
            for item in _elements(book.open(SHARED_STRINGS), MAIN + "sst", MAIN + "si"):
                strings.append("".join(text.text or "" for text in item.iter(MAIN + "t")))
        first = ElementTree.parse(book.open(WORKBOOK)).getroot().find(f"{MAIN}sheets/{MAIN}sheet")
        links = ElementTree.parse(book.open(RELATIONS)).getroot()
        target = next(link.get("Target") for link in links if link.get("Id") == first.get(RELATION))
        sheet = target.lstrip("/") if target.startswith("/") else "xl/" + target
        for element in _elements(book.open(sheet), MAIN + "sheetData", MAIN + "row"):
            cells: list[tuple[str | None, int]] = []
            for cell in element.iter(MAIN + "c"):
                place = _place(cell.get("r")) if cell.get("r") else len(cells)
                cells.extend([(None, 0)] * (place - len(cells)))
                text = _text(cell, strings)
                cells.append((text, _kind(cell, text)))
            if any(text is not None for text, _ in cells):
                yield cells


def _elements(file: BinaryIO, parent: str, tag: str) -> Iterator[ElementTree.Element]:
    """Elements of a parent, one at a time; those before are forgotten."""
    around = None
    for event, element in ElementTree.iterparse(file, ("start", "end")):
        if event == "start":
            around = element if element.tag == parent else around
        elif element.tag == tag:
            yield element
            if around is not None:
                del around[:]


def _place(reference: str) -> int:
    """Zero-based column of a cell reference such as ``AB12``."""
    place = 0
    for letter in re.match("[A-Z]+", reference).group():
        place = place * 26 + ord(letter) - ord("A") + 1
    return place - 1


def _kind(cell: ElementTree.Element, text: str | None) -> int:
    if text is None:
        return 0
    kind = cell.get("t", "n")
    if kind == "b":
        return BOOLEAN
    if kind == "n":
        return WHOLE if re.fullmatch(r"-?\d{1,18}", text) else NUMBER
    return TEXT


def _text(cell: ElementTree.Element, strings: Strings | Sequence[str]) -> str | None:
    if cell.get("t") == "inlineStr":
        return "".join(text.text or "" for text in cell.iter(MAIN + "t"))
    value, kind = cell.findtext(MAIN + "v"), cell.get("t", "n")
    if value is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    if kind == "n" and not value.lstrip("-").isdigit():
        # Stored with 17 digits: 27.559999999999999 is the number 27.56.
        return repr(float(value))
    return value
