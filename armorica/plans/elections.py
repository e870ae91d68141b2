"""Election results: camp scores of every result file, per year and file."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.functions import column, require_column, trim_headers
from armorica.operators.geography import keep_territory, normalise_geography
from armorica.operators.scores import KEPT, camp_scores_wide
from armorica.sinks import write_delimited
from armorica.sources import file_tree
from armorica.sources.tree import Group, add_from_path, file_year, output_name, read_labelled

FILE = "source_file"


def score_elections(
    spark: SparkSession, source: str, target: str, departments: Iterable[int] = v.DEPARTMENTS
) -> int:
    """Score all result files below ``source``; gives the number of rows written.

    Files of one header are scored in one plan, against the reference of their
    year, and written to ``<target>/source_file=<name>/annee=<year>``.
    """
    written = 0
    for turn, scores in enumerate(election_scores(spark, source, departments)):
        # Scoring keeps rows where they are, by source file.
        mode = "append" if turn else "overwrite"
        written += write_delimited(scores, target, partition_by=[FILE, v.YEAR], mode=mode)
    return written


def election_scores(
    spark: SparkSession, source: str, departments: Iterable[int] = v.DEPARTMENTS
) -> list[DataFrame]:
    """Scores with their file name and year, one DataFrame per distinct header."""
    files = file_tree(spark, source).one_level()
    is_reference = F.startswith("name", F.lit("Reference"))
    held = files.files.groupBy("folder").agg(F.bool_or(is_reference).alias("reference"), F.bool_or(~is_reference).alias("result"))
    lacking = sorted(row["folder"] for row in held.filter("result and not reference").select("folder").collect())
    if lacking:
        raise ValueError(f"no camp reference below {source} for {lacking}")
    groups = read_labelled(spark, files, {"reference": is_reference, "result": ~is_reference})
    references = [_reference(group) for group in groups if group.label == "reference"]
    results = [group for group in groups if group.label == "result"]
    if not results:
        return []
    reference = reduce(DataFrame.unionByName, references)
    scored = []
    for group in results:
        rows = add_from_path(group.table, {FILE: output_name(source), v.YEAR: file_year}, group)
        rows = keep_territory(normalise_geography(rows), departments)
        scored.append(camp_scores_wide(rows, reference, by=[v.YEAR], keep=(*KEPT, FILE)))
    return scored


def _reference(group: Group) -> DataFrame:
    table = add_from_path(trim_headers(group.table), {v.YEAR: file_year}, group)
    names = [require_column(table, name) for name in (v.REFERENCE_CODE, v.REFERENCE_CAMP)]
    return table.select(*[column(name) for name in names], v.YEAR).toDF(v.REFERENCE_CODE, v.REFERENCE_CAMP, v.YEAR)
