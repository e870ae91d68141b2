"""File trees as data: what lies where, and one scan per distinct header.

A file is a plain ``name.csv`` or ``name.xlsx``, or a folder ``name.csv`` or
``source_file=name.csv`` of part files as Spark writes it, where year folders such as
``annee=2017`` may lie in between. The name and the year of a file are read from
its path.

A tree stays a DataFrame: files are chosen, given their headers and grouped in Spark. Of the
groups the driver gets one row per header and folder, and reads folders of one header as a
whole; only files of a folder that holds several headers are named one by one.
"""

from __future__ import annotations

import logging
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.functions import first_year
from armorica.operators.joins import BROADCAST_BYTES, ROW_BYTES
from armorica.sources.delimited import header_schema, read_delimited, separator_for
from armorica.sources.store import add_first_lines
from armorica.sources.workbook import read_workbooks

log = logging.getLogger(__name__)

FILE_PATH = "_source_path"
SUFFIXES = (".csv", ".xlsx")
# What a listing takes.
FILES = "*.{csv,xlsx,CSV,XLSX}"
# [<folder>/]<folder>/[source_file=]<name>.<suffix>[/annee=<year>][/part-...]
LAYOUT = (
    r"(?i)^.*?/(?:([^/]+)/)?([^/]+)/(source_file=)?([^/]+\.(?:csv|xlsx))(?:/[^/=]+=([^/]*))?(?:/part-[^/]*)?$"
)
# The part of a path before the file, or before the folder that goes by the name of a file.
BEFORE = r"(?i)^(.*?)/(?:source_file=)?[^/]+\.(?:csv|xlsx)(?:/.*)?$"


@dataclass(frozen=True)
class SourceFile:
    """One physical file: its path, the name it goes by and its parent folder or year folder."""

    path: str
    name: str
    folder: str
    below: tuple[str, ...]
    length: int

    @property
    def depth(self) -> int:
        """Folders between the listed base and the file."""
        return len(self.below)

    @property
    def suffix(self) -> str:
        return self.name[self.name.rfind(".") :].lower()


@dataclass(frozen=True)
class FileTree:
    """Files below a base, one row each, and a condition that tells which of them are chosen.

    Columns: ``path``, ``length``, ``modified``, the path as scans spell it (``FILE_PATH``), ``name`` (the file goes by),
    ``folder`` (its parent or year folder), ``below`` (folders between base and file) and their
    number ``depth``, ``suffix``, ``place`` (folder that holds it) and ``part`` (of one write).
    """

    listed: DataFrame
    chosen: Column

    @property
    def files(self) -> DataFrame:
        return self.listed.filter(self.chosen)

    def where(self, condition: Column) -> FileTree:
        return FileTree(self.listed, self.chosen & F.coalesce(condition, F.lit(False)))

    def one_level(self) -> FileTree:
        """Files directly in the base or, if there are none, directly in its subfolders."""
        depth = 1 if self.files.filter("depth = 0").isEmpty() else 0
        return self.where(F.col("depth") == depth)

    def one_level_of_each(self) -> FileTree:
        """Of each folder in the base, the files directly in it or, if there are none, in its subfolders."""
        top = F.try_element_at("below", F.lit(1))
        inside = self.files.filter("depth > 0").groupBy(top.alias("_top")).agg(F.bool_or(F.col("depth") == 1).alias("_direct"))
        listed = self.listed.join(inside, top == F.col("_top"), "left")
        return FileTree(listed, self.chosen).where(F.col("depth") == F.when(F.col("_direct"), 1).otherwise(2))


def file_tree(spark: SparkSession, base: str) -> FileTree:
    """All delimited files and workbooks below ``base`` that are not empty; no content is read.

    A folder that is not there holds no files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        found = reader.option("pathGlobFilter", FILES).load(base)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.info("no folder %s", base)
        found = spark.createDataFrame([], "path string, length bigint, modified timestamp").withColumn("_spelt", F.lit(""))
    else:
        found = found.selectExpr("path", "length", "modificationTime as modified", "_metadata.file_path as _spelt")
    found = found.filter((F.col("length") > 0) & F.col("path").rlike(LAYOUT))
    root = _plain_path(base).rstrip("/")
    listed = found.selectExpr(
        "path",
        "length",
        "modified",
        f"_spelt as {FILE_PATH}",
        # Parent, folder, prefix, name, year folder.
        f"split(regexp_replace(path, {_quoted(LAYOUT)}, '$1\n$2\n$3\n$4\n$5'), '\n') as _parts",
        f"regexp_replace(regexp_extract(path, {_quoted(BEFORE)}, 1), '^[a-z0-9]+:/*(?=/)', '') as _before",
        "regexp_extract(path, '^(.*)/', 1) as place",
        "path rlike '/part-[^/]*$' as part",
    ).selectExpr(
        "path",
        "length",
        "modified",
        FILE_PATH,
        "if(_parts[2] != '', url_decode(replace(_parts[3], '+', '%2B')), _parts[3]) as name",
        "if(_parts[4] != '', _parts[4], _parts[1]) as folder",
        f"filter(split(if(startswith(_before, {_quoted(root)}), substr(_before, {len(root) + 1}), _before), '/'), x -> x != '') as below",
        "place",
        "part",
    )
    return FileTree(listed.selectExpr("*", "lower(regexp_extract(name, '[.][^.]*$', 0)) as suffix", "size(below) as depth"), F.lit(True))


def _quoted(text: str) -> str:
    """A text as a literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def list_files(spark: SparkSession, base: str) -> list[SourceFile]:
    """The files of a tree, sorted, on the driver: for a look at small trees."""
    return _collected(file_tree(spark, base))


def list_one_level(spark: SparkSession, base: str) -> list[SourceFile]:
    """Files directly in ``base`` or, if there are none, directly in its subfolders."""
    return _collected(file_tree(spark, base).one_level())


def _collected(tree: FileTree) -> list[SourceFile]:
    rows = tree.files.select("path", "name", "folder", "below", "length").collect()
    files = [SourceFile(row.path, row.name, row.folder, tuple(row.below), row.length) for row in rows]
    return sorted(files, key=lambda file: file.path)


def read_file(spark: SparkSession, path: str, typed: bool = False) -> DataFrame | None:
    """One file by its extension; None if it is not there. ``typed`` is that of ``read_workbooks``."""
    if not path.lower().endswith(SUFFIXES):
        raise ValueError(f"unsupported file format: {path}")
    try:
        if path.lower().endswith(".csv"):
            return read_delimited(spark, path, separator_for(path))
        return read_workbooks(spark, [_literal(path)], typed=typed)[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@dataclass(frozen=True)
class Group:
    """Files of one header as a table, each row with its path in ``FILE_PATH``; ``files`` has their paths.

    ``path_bytes``: size of these paths.
    """

    label: str
    table: DataFrame
    files: DataFrame
    path_bytes: int


def read_groups(spark: SparkSession, files: Iterable[SourceFile] | FileTree) -> list[DataFrame]:
    """The files as one DataFrame per distinct header, each with its path in ``FILE_PATH``."""
    if isinstance(files, FileTree):
        return [group.table for group in read_labelled(spark, files, {"": F.lit(True)})]
    paths = [(file.path, file.name, file.suffix, file.length) for file in files]
    if not paths:
        return []
    # Of named files nothing is known about the folders that hold them: each is a place of its own.
    listed = spark.createDataFrame(paths, "path string, name string, suffix string, length bigint")
    listed = listed.withColumns({FILE_PATH: F.col("path"), "place": F.regexp_extract("path", r"^(.*)/", 1), "part": F.lit(False)})
    groups = read_labelled(spark, FileTree(listed, F.lit(True)), {"": F.lit(True)}, whole_folders=False)
    return [group.table for group in groups]


def read_labelled(spark: SparkSession, tree: FileTree, labels: Mapping[str, Column], whole_folders: bool = True) -> list[Group]:
    """The chosen files as one group per label and distinct header.

    A label is a condition on the files; a file may have several. All headers are found in one
    job, which reads no more of a file than its first line.
    """
    found = _by_header(spark, tree, labels, whole_folders)
    groups = []
    for (label, suffix, sep, header), (paths, path_bytes) in found.items():
        files = tree.where(labels[label]).files.select(FILE_PATH)
        if suffix == ".xlsx":
            groups += [Group(label, table, files, path_bytes) for table in read_workbooks(spark, paths, FILE_PATH, typed=False)]
            continue
        scan = read_delimited(spark, paths, sep, header_schema(header, sep))
        groups.append(Group(label, scan.select("*", F.col("_metadata.file_path").alias(FILE_PATH)), files, path_bytes))
    return groups


def add_from_path(
    df: DataFrame, rules: Mapping[str, Callable[[Column], Column]], group: Group | None = None
) -> DataFrame:
    """Columns that rules such as ``file_name`` take from the path, in place of the path.

    With the ``group`` the rows come from, the rules are applied once per file and the result
    is joined to the rows, as matching the path of every row costs more than reading it.
    Without it, or with more files than can be broadcast, they are applied per row.
    """
    if group is None or group.path_bytes * (1 + len(rules)) > BROADCAST_BYTES:
        return _placed(df, rules).drop(FILE_PATH)
    known = _placed(group.files, rules)
    return df.drop(*rules).join(F.broadcast(known), FILE_PATH, "left").drop(FILE_PATH)


def path_columns(df: DataFrame, rules: Mapping[str, Callable[[Column], Column]], path: str) -> DataFrame:
    """The columns that rules take from a plain path, besides the others."""
    return _by_rules(df, rules, F.col(path))


def _placed(df: DataFrame, rules: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    return _by_rules(df, rules, _unescaped(F.col(FILE_PATH)))


def _by_rules(df: DataFrame, rules: Mapping[str, Callable[[Column], Column]], path: Column) -> DataFrame:
    parts = F.split(F.regexp_replace(path, LAYOUT, "$1/$2/$3/$4/$5"), "/")
    # The whole path comes last.
    placed = df.withColumn("_place", F.concat(parts, F.array(path)))
    return placed.withColumns({name: rule(F.col("_place")) for name, rule in rules.items()}).drop("_place")


def with_provenance(df: DataFrame, group: Group | None = None) -> DataFrame:
    """Type and year columns in place of the path."""
    return add_from_path(df, {v.TYPE: file_type, v.YEAR: file_year}, group)


def file_name(place: Column) -> Column:
    """Name of the file a row comes from, such as ``niveau-pauvrete-par-commune.csv``."""
    return F.when(place[2] == "", place[3]).otherwise(_unescaped(place[3]))


def file_year(place: Column) -> Column:
    """Year of the year folder around or in the file; null without one."""
    return _year(F.when(place[4] != "", place[4]).otherwise(place[1]))


def file_year_folder(place: Column) -> Column:
    """Year folder that holds the file or the folder of the file; null without one."""
    return F.coalesce(_year(place[1]), _year(place[0]))


def output_name(base: str) -> Callable[[Column], Column]:
    """Rule for the name of the delimited file a source file is converted to.

    The folders between ``base`` and the file are part of the name, but for the
    year folder, which is a column.
    """
    root = _plain_path(base).rstrip("/")
    before = rf"^.*?\Q{root}\E/+"
    after = r"(?i)/?(?:source_file=)?[^/]+\.(?:csv|xlsx)(?:/.*)?$"

    def rule(place: Column) -> Column:
        below = F.regexp_replace(F.regexp_replace(F.element_at(place, -1), before, ""), after, "")
        folders = F.filter(F.split(below, "/"), lambda folder: folder != "")
        year_at = F.when(_year(F.try_element_at(folders, F.lit(-1))).isNotNull(), F.size(folders) - 1)
        year_at = year_at.when(_year(F.try_element_at(folders, F.lit(-2))).isNotNull(), F.size(folders) - 2)
        others = F.filter(folders, lambda folder, at: at != F.coalesce(year_at, F.lit(-1)))
        name = F.regexp_replace(file_name(place), r"(?i)\.xlsx$", ".csv")
        return F.concat_ws("/", F.concat(others, F.array(name)))

    return rule


def file_type(place: Column) -> Column:
    """What a file is about: its name without territory suffix, hyphens as blanks, trimmed."""
    name = F.regexp_replace(file_name(place), r"^.*/", "")
    name = F.regexp_replace(name, r"(?i)par-(commune|departement|region)\.csv$", "")
    return F.trim(F.translate(name, "-", " "))


def _unescaped(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _year(folder: Column) -> Column:
    return first_year(F.when(F.length(folder) == 4, folder))


def _plain_path(path: str) -> str:
    return re.sub(r"^[a-z0-9]+:/*(?=/)", "", path)


_UNITS = "label string, suffix string, place string, part boolean, n bigint, octets bigint, one string, named string"


def _by_header(
    spark: SparkSession, tree: FileTree, labels: Mapping[str, Column], whole_folders: bool
) -> dict[tuple[str, str, str, str | None], tuple[list[str], int]]:
    """Paths and their size in bytes by label, suffix, separator and first line.

    Part files of one folder come from one write: the smallest stands for all.
    A part that has another header after all makes the later read fail. A folder whose
    files are all of one group is given as a pattern, files of other folders one by one.
    """
    # Every file counts once more, without a label.
    own = [F.when(tree.chosen & condition, F.lit(label)) for label, condition in labels.items()]
    own = F.concat(F.array(F.lit(None).cast("string")), F.array_compact(F.array(*own)))
    # All part files of a folder are one unit, every other file is one.
    unit = F.when(F.col("part"), "").otherwise(F.col("path"))
    units = (
        tree.listed.select("path", "name", "suffix", "length", "place", "part", unit.alias("unit"), F.explode(own).alias("label"))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "place", "unit")
        .groupBy("label", "suffix", "place", "part", "unit")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.octet_length("path") + ROW_BYTES).alias("octets"),
            F.min_by("path", F.struct("length", "path")).alias("one"),
            F.first("name").alias("named"),
        )
        .drop("unit")
    )
    wanted = F.col("label").isNotNull() & (F.col("suffix") == ".csv")
    units = units.withColumns({"wanted": wanted, "header": F.lit(None).cast("string"), "readable": F.lit(True)})
    found = units.mapInArrow(add_first_lines, f"{_UNITS}, wanted boolean, header string, readable boolean")
    rows = _folders(found).collect()
    if not all(row["readable"] for row in rows):
        # A store that only Spark opens: its text scan reads the files.
        unknown = [row["one"] for row in units.filter("wanted").select("one").distinct().collect()]
        found = units.drop("header").join(_scanned_headers(spark, unknown), "one", "left")
        rows = _folders(found).collect()
    files_in = {row["place"]: 0 for row in rows}
    for row in rows:
        files_in[row["place"]] += row["n"] if row["label"] is None else 0
    # Folders in which another one goes by the name of a file: a pattern of files would take it too.
    around = {row["before"] for row in rows if row["before"]}
    groups: dict[tuple, tuple[list[str], list[int]]] = defaultdict(lambda: ([], []))
    several = []
    for row in rows:
        if row["label"] is None:
            continue
        paths, octets = groups[_key(row)]
        octets.append(row["octets"])
        place, suffix = row["place"], row["suffix"][1:]
        if row["part"]:
            paths.append(_pattern(place, f"part-*.{{{suffix},{suffix.upper()}}}"))
        elif row["n"] == 1:
            paths.append(_literal(row["one"]))
        elif whole_folders and row["n"] == files_in[place] and place not in around:
            paths.append(_pattern(place, f"*.{{{suffix},{suffix.upper()}}}"))
        else:
            several.append(tuple(row[name] for name in ("label", "suffix", "place", "header")))
    if several:
        mixed = F.broadcast(spark.createDataFrame(several, "label string, suffix string, place string, header string"))
        same = (found["label"] == mixed["label"]) & (found["suffix"] == mixed["suffix"]) & (found["place"] == mixed["place"])
        same = same & found["header"].eqNullSafe(mixed["header"])
        named = found.filter("not part").join(mixed, same, "left_semi").select("label", "suffix", "header", "one", _separator(F.col("named")))
        for row in named.collect():
            groups[_key(row)][0].append(_literal(row["one"]))
    return {key: (sorted(paths), sum(octets)) for key, (paths, octets) in sorted(groups.items(), key=lambda item: min(item[1][0]))}


def _key(row: Row) -> tuple[str, str, str, str | None]:
    return row["label"], row["suffix"], row["separator"], row["header"]


def _folders(units: DataFrame) -> DataFrame:
    """Units by label, folder and header."""
    before = F.regexp_extract("place", BEFORE, 1)
    keys = ["label", "suffix", "place", "part", "header", "readable", _separator(F.col("named")), before.alias("before")]
    return units.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("octets").alias("octets"), F.min("one").alias("one"))


def _separator(name: Column) -> Column:
    """``separator_for`` of the name of a file."""
    stem = v.REFERENCE_FILE.removesuffix(".csv").lower()
    return F.when(F.contains(F.lower(name), F.lit(stem)), ",").otherwise(";").alias("separator")


def _scanned_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows (one, header) of first lines found by a scan of whole files."""
    lines = spark.read.text([_literal(path) for path in paths]).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("position"),
    )
    first = lines.filter("start = 0 and trim(value) != ''").groupBy("path").agg(F.min_by("value", "position").alias("header"))
    return first.select(_unescaped(F.col("path")).alias("one"), "header")


def _literal(path: str) -> str:
    """A path whose characters stand for themselves where Spark takes patterns."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def _pattern(place: str, names: str) -> str:
    return f"{_literal(place)}/{names}"
