"""Vote shares added up by political camp.

A reference table gives the camp of each candidate code. Codes without a camp
count in neither; what the two camps leave of 100 is the third score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.functions import column, find_column, percent, remainder, require_column, sum_columns, trim_headers
from armorica.operators.geography import plain_codes
from armorica.operators.joins import BROADCAST_BYTES, is_small
from armorica.workspace import new_folder

CAMPS = {v.SCORE_LEFT: v.LEFT, v.SCORE_RIGHT: v.RIGHT}
SHARE_TYPE = "decimal(18,10)"
# No longer used: equal rows are not counted and repeated any more. A test still sets it.
COPIES_AT_ONCE = 10_000
KEPT = (
    v.COMMUNE_CODE,
    v.COMMUNE_LABEL,
    v.COMMUNE_PART,
    v.DEPARTMENT,
    v.DEPARTMENT_LABEL,
    v.TURNOUT,
    v.SCORE_LEFT,
    v.SCORE_RIGHT,
    v.SCORE_OTHER,
)


def camp_lookup(reference: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """One row per code: its camp in lower case, next to the ``extra`` key columns.

    Rows without a code or a camp are left out; of several camps for one code
    the greatest in text order is taken, whatever their case or the order of the rows.
    """
    reference = trim_headers(reference)
    code = column(require_column(reference, v.REFERENCE_CODE))
    camp = column(require_column(reference, v.REFERENCE_CAMP))
    return (
        reference.filter(code.isNotNull() & camp.isNotNull())
        .groupBy(*[column(name) for name in extra], code.alias("code"))
        .agg(F.max(F.lower(camp)).alias("camp"))
    )


def candidate_pairs(df: DataFrame) -> list[tuple[str, str]]:
    """(code header, share header) of each candidate; a code without its share is skipped."""
    pairs = []
    for header in df.columns:
        if header.startswith(v.CANDIDATE_PREFIX):
            share = v.VOTE_SHARE_PREFIX + header.removeprefix(v.CANDIDATE_PREFIX)
            if share in df.columns:
                pairs.append((header, share))
    return pairs


def camp_scores_long(
    df: DataFrame,
    keys: Sequence[str],
    code: str,
    vote_share: str,
    reference: DataFrame,
    nulls: str = "propagate",
    number: str = SHARE_TYPE,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Scores per territory of rows (territory, candidate code, share text).

    ``nulls="propagate"`` makes a score null when a share of that camp is
    missing; ``"zero"`` counts the missing share as nothing. Shares are added
    as decimals, so that the order of partitions does not matter; a ``number``
    of at most 8 digits, such as ``decimal(8,4)``, is added twice as fast.
    """
    lookup = camp_lookup(reference)
    value = percent(column(vote_share), number)
    rows = df.select(
        *[column(key) for key in keys],
        column(code).alias("code"),
        value.alias("total"),
        value.isNull().cast("int").alias("missing"),
    )
    if is_small(lookup, max_bytes):
        lookup = F.broadcast(lookup)
    else:
        # A code may hold a third of the rows: leave one row per territory and
        # code before the shuffle on the code.
        rows = rows.groupBy(*[column(key) for key in keys], "code").agg(
            F.sum("total").alias("total"), F.sum("missing").alias("missing")
        )
    camps = rows.join(lookup, "code", "left")
    sums, gaps = {}, {}
    for score, camp in CAMPS.items():
        sums[score] = F.coalesce(F.sum(F.when(F.col("camp") == camp, F.col("total"))), F.lit(0))
        gaps[score] = F.sum(F.when(F.col("camp") == camp, F.col("missing")))
    totals = camps.groupBy(*[column(key) for key in keys]).agg(
        *[_masked(sums[score], gaps[score], nulls).alias(score) for score in CAMPS]
    )
    return totals.select(*[column(key) for key in keys], *_scores({score: column(score) for score in CAMPS}))


def camp_scores_wide(
    df: DataFrame,
    reference: DataFrame,
    by: Sequence[str] = (),
    keep: Sequence[str] = KEPT,
    nulls: str = "propagate",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Scores of rows that hold one pair of columns per candidate.

    Columns in ``by`` are further keys of the reference, such as the year. A
    reference within the bound is broadcast once and looked up per candidate,
    without a shuffle. Beyond it only the different lists of codes meet the
    reference, however many rows and candidates there are; the rows are read
    twice and shuffled once at the most, by their list.
    """
    pairs = candidate_pairs(df)
    lookup = camp_lookup(reference, by)
    kept = [name for name in (*keep, *by) if find_column(df, name) == name]
    if not pairs:
        joined = df
    elif is_small(lookup, max_bytes):
        joined = _camps_by_lookup(df, pairs, F.broadcast(lookup), by)
    else:
        joined = _camps_by_shuffle(df, pairs, lookup, by)
    votes: dict[str, list[Column]] = {score: [] for score in CAMPS}
    for turn, (_, vote_share) in enumerate(pairs):
        value = percent(column(vote_share))
        if nulls == "zero":
            value = F.coalesce(value, F.lit(0))
        for score, camp in CAMPS.items():
            votes[score].append(F.when(F.col(f"_camp_{turn}") == camp, value).otherwise(F.lit(0)))
    sums = {score: sum_columns(votes[score]) for score in CAMPS}
    scored = joined.select(*[column(name) for name in df.columns if name in kept], *_scores(sums))
    return plain_codes(scored, [v.DEPARTMENT, v.COMMUNE_PART])


def _camps_by_lookup(
    df: DataFrame, pairs: Sequence[tuple[str, str]], lookup: DataFrame, by: Sequence[str]
) -> DataFrame:
    """The camp of each candidate as ``_camp_<turn>``, by one look into the lookup each."""
    for turn, (code, _) in enumerate(pairs):
        side = lookup.select(
            *[column(key).alias(f"_key{i}_{turn}") for i, key in enumerate(by)],
            F.col("code").alias(f"_code_{turn}"),
            F.col("camp").alias(f"_camp_{turn}"),
        )
        same = column(code) == F.col(f"_code_{turn}")
        for i, key in enumerate(by):
            same = same & (column(key) == F.col(f"_key{i}_{turn}"))
        df = df.join(side, same, "left")
    return df


def _camps_by_shuffle(
    df: DataFrame, pairs: Sequence[tuple[str, str]], lookup: DataFrame, by: Sequence[str]
) -> DataFrame:
    """The same columns by way of the different lists of codes.

    Rows of one list have the same camps. A list becomes one row per candidate,
    which meets the lookup by code, where adaptive execution splits a hot one.
    The camps of a list come together again and are kept in the shared folder,
    for Spark to choose by their size how the rows look up their list.
    """
    spark = df.sparkSession
    keys = [column(key).alias(f"_key{i}") for i, key in enumerate(by)]
    codes = F.array(*[column(code) for code, _ in pairs])
    rows = df.withColumn("_list", F.struct(*keys, codes.alias("_codes")))
    names = F.array(*[F.lit(camp) for camp in CAMPS.values()])
    # Camps as numbers are gathered in hash maps.
    side = lookup.select(*keys, F.col("code").alias("_code"), F.array_position(names, F.col("camp")).alias("_camp"))
    same = F.col("_candidate") == F.col("_code")
    for i in range(len(by)):
        same = same & (F.col(f"_list._key{i}") == F.col(f"_key{i}"))
    candidates = rows.select("_list").distinct().select("_list", F.posexplode("_list._codes").alias("_turn", "_candidate"))
    camps = [F.max(F.when(F.col("_turn") == turn, F.col("_camp"))) for turn in range(len(pairs))]
    met = candidates.join(side, same, "left").groupBy("_list").agg(F.array(*camps).alias("_camps"))
    folder = new_folder(spark, "camps")
    met.write.parquet(folder)
    found = F.coalesce(F.col("_camps"), F.raise_error(F.lit("rows have other codes when read again")))
    return rows.join(spark.read.parquet(folder), "_list", "left").select(
        *[column(name) for name in df.columns],
        *[F.get(names, F.get(found, F.lit(turn)) - 1).alias(f"_camp_{turn}") for turn in range(len(pairs))],
    )


def _masked(total: Column, gaps: Column, nulls: str) -> Column:
    if nulls == "zero":
        return total
    return F.when(gaps > 0, F.lit(None)).otherwise(total)


def _scores(sums: dict[str, Column]) -> list[Column]:
    sums = {**sums, v.SCORE_OTHER: remainder(100, *sums.values())}
    return [F.round(total, 2).cast("double").alias(score) for score, total in sums.items()]
