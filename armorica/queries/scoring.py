"""Camp scores: candidates are order lines, their code the return flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.functions import percent
from armorica.operators.scores import camp_scores_long, camp_scores_wide
from armorica.queries.registry import query, table

# The share of a line, exact to four digits, and its spelling as 12,3400%.
SHARE_SQL = """cast(l_quantity as decimal(4,0)) * (1 - cast(l_discount as decimal(3,2)))
  * (1 + cast(l_tax as decimal(3,2)))"""
REFERENCE_SQL = "(values ('R', 'gauche'), ('A', 'droite')) as ref(code, camp)"


def reference(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """select * from values ('R', 'Red', 'Gauche'), ('A', 'Amber', 'DROITE'), ('N', 'Neutral', null)
        as ref(`Code `, Nuance, orientation)"""
    )


def share_text() -> Column:
    quantity = F.col("l_quantity").cast("decimal(4,0)")
    discount = F.col("l_discount").cast("decimal(3,2)")
    tax = F.col("l_tax").cast("decimal(3,2)")
    number = quantity * (F.lit(1) - discount) * (F.lit(1) + tax)
    return F.concat(F.translate(number.cast("decimal(8,4)").cast("string"), ".", ","), F.lit("%"))


def votes(spark: SparkSession, folder: str, blank_without_tax: bool = False) -> DataFrame:
    text = share_text()
    if blank_without_tax:
        text = F.when(F.col("l_tax") != 0, text)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", text.alias("share"))


def scores(spark: SparkSession, rows: DataFrame, **options: object) -> DataFrame:
    """Scores per order; the shares have four digits after the point."""
    camps = reference(spark)
    return camp_scores_long(rows, ["l_orderkey"], "l_returnflag", "share", camps, number="decimal(8,4)", **options)


def score_sql(share: str, left: str = "g", right: str = "d") -> str:
    return f"""
with votes as (
  select l_orderkey, camp, {share} as share from lineitem left join {REFERENCE_SQL} on l_returnflag = code
), sums as (
  select l_orderkey,
    coalesce(sum(case when camp = 'gauche' then share end), 0) as g,
    coalesce(sum(case when camp = 'droite' then share end), 0) as d,
    count(case when camp = 'gauche' and share is null then 1 end) as gaps_g,
    count(case when camp = 'droite' and share is null then 1 end) as gaps_d
  from votes group by l_orderkey
), masked as (select l_orderkey, {left} as g, {right} as d from sums)
select l_orderkey,
  cast(round(g, 2) as double) as "Score_Gauche",
  cast(round(d, 2) as double) as "Score_Droite",
  cast(case when 100 - g - d < 0 then 0 else round(100 - g - d, 2) end as double) as "Score_Divers"
from masked"""


GAPS = f"case when l_tax <> 0 then {SHARE_SQL} end"


@query(score_sql(SHARE_SQL))
def camp_score_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = votes(spark, folder)
    return scores(spark, rows)


@query(score_sql(SHARE_SQL))
def camp_score_large_reference(spark: SparkSession, folder: str) -> DataFrame:
    """The way taken when the reference is beyond the broadcast bound."""
    rows = votes(spark, folder)
    return scores(spark, rows, max_bytes=0)


@query(score_sql(GAPS, "case when gaps_g = 0 then g end", "case when gaps_d = 0 then d end"))
def camp_score_missing_share(spark: SparkSession, folder: str) -> DataFrame:
    rows = votes(spark, folder, blank_without_tax=True)
    return scores(spark, rows)


@query(score_sql(GAPS))
def camp_score_missing_as_zero(spark: SparkSession, folder: str) -> DataFrame:
    rows = votes(spark, folder, blank_without_tax=True)
    return scores(spark, rows, nulls="zero")


def ballots(lines: DataFrame, *keys: str) -> DataFrame:
    """One row per key with a pair of columns per line number, the greatest where one repeats.

    Flags are compared by letter code and shares as numbers, which keeps the
    aggregation in hash maps.
    """
    cells, spelled = [], []
    for number in range(1, 8):
        here = F.col("l_linenumber") == number
        cells.append(F.max(F.when(here, F.ascii("l_returnflag"))).alias(f"code{number}"))
        cells.append(F.max(F.when(here, F.col("l_quantity"))).alias(f"share{number}"))
        spelled.append(F.chr(f"code{number}").alias(f"{v.CANDIDATE_PREFIX}{number}"))
        text = F.concat(F.col(f"share{number}").cast("int").cast("string"), F.lit(",00%"))
        spelled.append(text.alias(f"{v.VOTE_SHARE_PREFIX}{number}"))
    names = [f"`{key}`" for key in keys]
    return lines.groupBy(*names).agg(*cells).select(*names, *spelled)


def ballot_sql(keys: str, source: str) -> str:
    cells = ", ".join(
        f"max(case when l_linenumber = {n} then l_returnflag end) as c{n}, "
        f"max(case when l_linenumber = {n} then l_quantity end) as s{n}"
        for n in range(1, 8)
    )
    sums = {
        camp: " + ".join(f"case when c{n} in ({codes}) then s{n} else 0 end" for n in range(1, 8))
        for camp, codes in (("g", "'R'"), ("d", "'A'"))
    }
    return f"""
with ballots as (select {keys}, {cells} from {source} group by {keys}),
sums as (select {keys}, {sums['g']} as g, {sums['d']} as d from ballots)
select {keys}, g as "Score_Gauche", d as "Score_Droite", greatest(100 - g - d, 0) as "Score_Divers" from sums"""


@query(ballot_sql("l_orderkey", "lineitem"))
def camp_score_wide(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(table(spark, folder, "lineitem"), "l_orderkey")
    keep = ["l_orderkey", v.SCORE_LEFT, v.SCORE_RIGHT, v.SCORE_OTHER]
    return camp_scores_wide(rows, reference(spark), keep=keep)


@query(ballot_sql("l_orderkey", "lineitem"))
def camp_score_wide_large_reference(spark: SparkSession, folder: str) -> DataFrame:
    """The way taken when the reference is beyond the broadcast bound: one join for all candidates."""
    rows = ballots(table(spark, folder, "lineitem"), "l_orderkey")
    keep = ["l_orderkey", v.SCORE_LEFT, v.SCORE_RIGHT, v.SCORE_OTHER]
    return camp_scores_wide(rows, reference(spark), keep=keep, max_bytes=0)


@query(score_sql(SHARE_SQL))
def camp_score_two_camps(spark: SparkSession, folder: str) -> DataFrame:
    """A code of two camps counts for the greatest in text order, however they are spelled."""
    twice = reference(spark).unionByName(
        spark.sql("select * from values ('R', 'Red', 'DROITE'), ('A', 'Amber', 'droite') as ref(`Code `, Nuance, orientation)")
    )
    rows = votes(spark, folder)
    return camp_scores_long(rows, ["l_orderkey"], "l_returnflag", "share", twice, number="decimal(8,4)")


@query(
    """
select l_orderkey, l_linenumber,
  cast(cast(l_discount * 100 as decimal(5,2)) as double) as discount,
  case when l_returnflag <> 'N' then cast(cast(l_tax * 100 as decimal(5,2)) as double) end as tax
from lineitem"""
)
def pct_parse(spark: SparkSession, folder: str) -> DataFrame:
    discount = (F.col("l_discount") * 100).cast("decimal(5,2)").cast("string")
    tax = (F.col("l_tax") * 100).cast("decimal(5,2)").cast("string")
    spelled = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.translate(discount, ".", ","), F.lit("%")).alias("discount"),
        F.when(F.col("l_returnflag") != "N", tax).otherwise("n/a").alias("tax"),
    )
    return spelled.select(
        "l_orderkey",
        "l_linenumber",
        percent(F.col("discount"), "decimal(8,4)").cast("double").alias("discount"),
        percent(F.col("tax")).alias("tax"),
    )
