"""Whole plans, run on file trees that Spark derives from the test tables."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.concurrency import run_together
from armorica.plans import (
    average_poverty,
    average_social_index,
    check_warehouse,
    convert_yearly,
    export_facts,
    load_dimensions,
    load_facts,
    pivot_crime,
    score_elections,
    share_diplomas,
)
from armorica.plans.conversion import converted
from armorica.queries.facts import geography, region_of
from armorica.queries.registry import query, table
from armorica.queries.scoring import ballots
from armorica.queries.statistics import diploma_counts, diploma_sql
from armorica.sinks import read_facts, write_delimited
from armorica.sources import file_tree, read_delimited, read_file
from armorica.workspace import new_folder

NATIONS = range(25)
ORDER_YEAR = "cast(year(o_orderdate) as integer)"


def number(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def election_sql() -> str:
    cells = ", ".join(
        f"max(case when l_linenumber = {n} then l_returnflag end) as c{n}, "
        f"max(case when l_linenumber = {n} then l_quantity end) as s{n}"
        for n in range(1, 8)
    )
    sums = {
        camp: " + ".join(f"case when {test.format(n=n)} then s{n} else 0 end" for n in range(1, 8))
        for camp, test in (
            ("g", "c{n} = case when annee < 1998 then 'R' else 'A' end"),
            ("d", "c{n} = case when annee < 1998 then 'A' else 'N' end"),
        )
    }
    return f"""
with ballots as (
  select o_custkey, c_nationkey, {ORDER_YEAR} as annee, {cells}
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  group by all
), sums as (select o_custkey, c_nationkey, annee, {sums['g']} as g, {sums['d']} as d from ballots)
select cast(c_nationkey as varchar) as "Code département", 'client ' || o_custkey as "LIBGEO", annee,
  cast(g as double) as "Score_Gauche", cast(d as double) as "Score_Droite",
  cast(greatest(100 - g - d, 0) as double) as "Score_Divers"
from sums"""


@query(election_sql())
def election_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Result files per year, each scored against the reference of its year."""
    base = new_folder(spark, "elections")
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    lines = table(spark, folder, "lineitem")
    placed = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    keyed = placed.select(
        "l_linenumber",
        "l_returnflag",
        "l_quantity",
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")).alias(v.DEPARTMENT),
        F.concat_ws(" ", F.lit("client"), "o_custkey").alias(v.COMMUNE_LABEL),
        F.year("o_orderdate").alias(v.YEAR),
    )
    wide = ballots(keyed, v.DEPARTMENT, v.COMMUNE_LABEL, v.YEAR)
    write_delimited(wide, f"{base}/in/resultats.csv", partition_by=[v.YEAR])
    years = orders.select(F.year("o_orderdate").alias(v.YEAR)).distinct()
    early = F.expr("map('R', 'Gauche', 'A', 'Droite', 'N', null)")
    late = F.expr("map('A', 'gauche', 'N', 'DROITE', 'Z', '')")
    camps = years.select(
        v.YEAR, F.explode(F.when(F.col(v.YEAR) < 1998, early).otherwise(late)).alias("Code", "Orientation")
    )
    write_delimited(camps, f"{base}/in/{v.REFERENCE_FILE}", partition_by=[v.YEAR], sep=",")
    score_elections(spark, f"{base}/in", f"{base}/out", departments=NATIONS)
    back = read_delimited(spark, f"{base}/out")
    scores = [number(name) for name in (v.SCORE_LEFT, v.SCORE_RIGHT, v.SCORE_OTHER)]
    return back.select(F.col(f"`{v.DEPARTMENT}`"), v.COMMUNE_LABEL, v.YEAR, *scores)


def commune_code() -> Column:
    """A code of five characters: the nation in two, the customer's last three digits."""
    return F.concat(F.lpad("c_nationkey", 2, "0"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"))


COMMUNE_CODE_SQL = "lpad(cast(c_nationkey as varchar), 2, '0') || lpad(cast(c_custkey % 1000 as varchar), 3, '0')"


LINES_SQL = "customer join orders on c_custkey = o_custkey join lineitem on l_orderkey = o_orderkey"
MEAN_TEXT_SQL = "format('{:,.2f}', cast(sum(cast(l_quantity as integer)) as double) / count(*))"


@query(
    f"""
select {COMMUNE_CODE_SQL} as "CODGEO", c_name as "LIBGEO", {MEAN_TEXT_SQL} as taux_pauvrete_commune
from {LINES_SQL} where c_nationkey in (3, 7, 11, 22, 24) group by c_custkey, c_nationkey, c_name"""
)
def poverty_plan(spark: SparkSession, folder: str) -> DataFrame:
    base = new_folder(spark, "poverty")
    rows = _lines_of_customers(spark, folder).select(
        commune_code().alias(v.COMMUNE_CODE),
        F.col("c_name").alias(v.COMMUNE_LABEL),
        F.col("l_quantity").cast("int").alias(v.POVERTY_METRIC),
    )
    write_delimited(rows, f"{base}/in.csv")
    average_poverty(spark, f"{base}/in.csv", f"{base}/out.csv", departments=(3, 7, 11, 22, 24))
    return read_file(spark, f"{base}/out.csv")


@query(
    f"""
select {COMMUNE_CODE_SQL} as "CODGEO", c_name as "LIBGEO", {ORDER_YEAR} as annee,
  {MEAN_TEXT_SQL} as indice_position_sociale
from {LINES_SQL} group by c_custkey, c_nationkey, c_name, {ORDER_YEAR}"""
)
def social_index_plan(spark: SparkSession, folder: str) -> DataFrame:
    base = new_folder(spark, "social")
    year = F.year("o_orderdate")
    rows = _lines_of_customers(spark, folder).select(
        commune_code().alias(v.COMMUNE_CODE),
        F.col("c_name").alias(v.COMMUNE_LABEL),
        F.concat_ws("-", year, year + 1).alias(v.YEAR),
        F.col("l_quantity").cast("int").alias(v.SOCIAL_METRIC),
    )
    write_delimited(rows, f"{base}/in.csv")
    average_social_index(spark, f"{base}/in.csv", f"{base}/out.csv", departments=NATIONS)
    return read_file(spark, f"{base}/out.csv")


def _lines_of_customers(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )


@query(
    """
select cast(n_regionkey as varchar) as "Code région", 'piece ' || l_partkey as indicateur,
  l_returnflag as "unite de compte",
  max(case when year(l_shipdate) = 1996 then l_quantity end) as "taux pour mille 1996",
  max(case when year(l_shipdate) = 1998 then l_quantity end) as "taux pour mille 1998"
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
where year(l_shipdate) in (1996, 1998) and n_regionkey in (1, 3)
group by n_regionkey, l_partkey, l_returnflag"""
)
def crime_plan(spark: SparkSession, folder: str) -> DataFrame:
    base = new_folder(spark, "crime")
    suppliers = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    lines = table(spark, folder, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = lines.select(
        F.col("n_regionkey").cast("double").alias(v.REGION),
        F.concat_ws(" ", F.lit("piece"), "l_partkey").alias(v.INDICATOR),
        F.col("l_returnflag").alias(v.UNIT),
        F.year("l_shipdate").alias(v.YEAR),
        F.col("l_quantity").alias(v.RATE),
    )
    write_delimited(rows, f"{base}/in.csv")
    pivot_crime(spark, f"{base}/in.csv", f"{base}/out.csv", regions=(1, 3), years=(1996, 1998))
    back = read_file(spark, f"{base}/out.csv")
    rates = [number(f"{v.RATE} {year}") for year in (1996, 1998)]
    return back.select(F.col(f"`{v.REGION}`"), v.INDICATOR, F.col(f"`{v.UNIT}`"), *rates)


@query(
    f"""
with shares as ({diploma_sql("l_suppkey")}), coded as (
  select *, lpad(cast(l_suppkey as varchar), 5, '0') as code, 'fournisseur ' || l_suppkey as label from shares
)
select code as "CODGEO", cast(cast(substr(code, 1, 2) as integer) as varchar) as "Code département",
  substr(code, 3, 3) as "Code de la commune", label as "LIBGEO", * exclude (l_suppkey, code, label)
from coded"""
)
def education_plan(spark: SparkSession, folder: str) -> DataFrame:
    base = new_folder(spark, "education")
    counts = diploma_counts(spark, folder, "l_suppkey", absent=0)
    rows = counts.withColumn(v.COMMUNE_LABEL, F.concat_ws(" ", F.lit("fournisseur"), "l_suppkey"))
    write_delimited(rows.withColumnRenamed("l_suppkey", v.COMMUNE_CODE), f"{base}/in.csv")
    # A list of départements as long as the data has, given as they stand.
    share_diplomas(spark, f"{base}/in.csv", f"{base}/out.csv", departments=range(100))
    back = read_file(spark, f"{base}/out.csv")
    codes = [F.col(f"`{name}`") for name in (v.COMMUNE_CODE, v.DEPARTMENT, v.COMMUNE_PART, v.COMMUNE_LABEL)]
    shares = [number(name) for name in back.columns if name.startswith("taux")]
    return back.select(*codes, F.col(v.POPULATION).cast("bigint").alias(v.POPULATION), *shares)


@query(
    f"""
select o_orderkey, {ORDER_YEAR} as annee, cast(c_nationkey as varchar) as "Code département",
  case when year(o_orderdate) < 1998 then 'loyers' else 'charges' end as dataset
from orders join customer on o_custkey = c_custkey where c_nationkey in (3, 7, 11, 22, 24)"""
)
def yearly_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Two datasets by year, kept to the territory and mirrored."""
    base = new_folder(spark, "yearly")
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("c_nationkey").alias("code département"), F.year("o_orderdate").alias(v.YEAR)
    )
    # Stored by year first, so that each file is written from its own part.
    rows.write.partitionBy(v.YEAR).parquet(f"{base}/rows")
    years = spark.read.parquet(f"{base}/rows").select(v.YEAR).distinct().collect()

    def write(year: int) -> None:
        dataset = "loyers" if year < 1998 else "charges"
        of_year = spark.read.parquet(f"{base}/rows").filter(F.col(v.YEAR) == year).drop(v.YEAR)
        write_delimited(of_year, f"{base}/in/{dataset}/{year}/{dataset}-par-departement.csv")

    run_together(spark, {year: partial(write, year) for (year,) in years}, "year")
    convert_yearly(spark, f"{base}/in", f"{base}/out", ["loyers", "charges"], departments=(3, 7, 11, 22, 24))
    back = [read_delimited(spark, f"{base}/out/{dataset}") for dataset in ("loyers", "charges")]
    return back[0].unionByName(back[1]).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("year_folder").alias(v.YEAR),
        F.col(f"`{v.DEPARTMENT}`"),
        F.regexp_extract("source_file", "^[a-z]+", 0).alias("dataset"),
    )


@query(
    """
select lpad(cast(c_nationkey as varchar), 2, '0') as "Code département",
  lpad(cast(c_custkey % 1000 as varchar), 3, '0') as "Code de la commune",
  lpad(cast(c_nationkey as varchar), 2, '0') || lpad(cast(c_custkey % 1000 as varchar), 3, '0') as "CODGEO",
  c_mktsegment as segment, 'clients.csv' as source_file, null as solde
from customer
union all
select substr(code, 1, 2), substr(code, 3, 3), code, null, 'fournisseurs.csv', solde
from (select lpad(cast(l_suppkey as varchar), 5, '0') as code, cast(l_linenumber as varchar) as solde from lineitem)"""
)
def tree_conversion(spark: SparkSession, folder: str) -> DataFrame:
    """Files of two headers brought to canonical codes, no row left out."""
    base = new_folder(spark, "conversion")
    customers = table(spark, folder, "customer").select(
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")).alias("Code Département"),
        (F.col("c_custkey") % 1000).alias(v.COMMUNE_PART),
        F.col("c_mktsegment").alias("segment"),
    )
    write_delimited(customers, f"{base}/clients.csv")
    lines = table(spark, folder, "lineitem").select(
        F.concat(F.col("l_suppkey").cast("string"), F.lit(".0")).alias(v.COMMUNE_CODE),
        F.col("l_linenumber").alias("solde"),
    )
    write_delimited(lines, f"{base}/fournisseurs.csv")
    tables = converted(spark, file_tree(spark, base).one_level(), base)
    return tables[0].unionByName(tables[1], allowMissingColumns=True).drop("year_folder")


@query(
    f"""
select cast(c_custkey as varchar) as key, cast(c_nationkey as varchar) as "Code département", 2017 as annee,
  case when c_custkey % 2 = 0 then 'nord/clients.csv' else 'sud/clients.csv' end as source_file from customer
union all
select cast(s_suppkey as varchar), cast(s_nationkey as varchar), 2018, 'clients.csv' from supplier"""
)
def mirrored_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Files of equal name from several folders stay apart when a tree is converted."""
    base = new_folder(spark, "mirrored")
    customers = table(spark, folder, "customer")
    rows = customers.select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias(v.DEPARTMENT))
    for turn, side in enumerate(("nord", "sud")):
        write_delimited(rows.filter(F.col("key") % 2 == turn), f"{base}/in/ventes/2017/{side}/clients.csv")
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias(v.DEPARTMENT)
    )
    write_delimited(suppliers, f"{base}/in/ventes/2018/clients.csv")
    codes = table(spark, folder, "nation").select("n_nationkey")
    convert_yearly(spark, f"{base}/in", f"{base}/out", ["ventes"], departments=codes)
    back = read_delimited(spark, f"{base}/out/ventes")
    return back.select("key", F.col(f"`{v.DEPARTMENT}`"), F.col("year_folder").alias(v.YEAR), "source_file")


WAREHOUSE_SQL = f"""
with counted as (
  select o_custkey, {ORDER_YEAR} as annee, count(*) as orders from orders group by all
), nation_years as (
  select c_nationkey, n_name, count(case when year(o_orderdate) = 1996 then 1 end) as n1996,
    count(case when year(o_orderdate) = 1998 then 1 end) as n1998
  from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey group by all
), region_years as (
  select n_regionkey, c_mktsegment as indicateur, count(case when year(o_orderdate) = 1997 then 1 end) as n1997
  from orders join customer on o_custkey = c_custkey join nation on n_nationkey = c_nationkey group by all
)
select cast(c_custkey as varchar) as "CODGEO", c_name as "LIBGEO", c_nationkey as "Code département", annee,
  'commandes' as type, cast(json_object('orders', cast(orders as varchar), 'code_com', cast(c_custkey as varchar),
    'nom_com', c_name, 'geo_point', c_mktsegment, 'code_dep', c_nationkey) as varchar) as data
from counted join customer on o_custkey = c_custkey
union all
select cast(c.c_custkey as varchar), c.c_name, c.c_nationkey, y.annee, 'ventes',
  cast(json_object('code_com', cast(c.c_custkey as varchar), 'nom_com', c.c_name, 'geo_point', c.c_mktsegment,
    'code_dep', c.c_nationkey, 'typeMetric', 'Ventes', 'valeur', cast(y.valeur as varchar)) as varchar)
from customer c join (
  select c_nationkey, 1996 as annee, n1996 as valeur from nation_years
  union all select c_nationkey, 1998, n1998 from nation_years
) y on c.c_nationkey = y.c_nationkey
union all
select cast(c.c_custkey as varchar), c.c_name, c.c_nationkey, 1997, 'delits',
  cast(json_object('code_com', cast(c.c_custkey as varchar), 'nom_com', c.c_name, 'geo_point', c.c_mktsegment,
    'code_dep', c.c_nationkey, 'indicateur', r.indicateur, 'typeMetric', 'taux pour mille',
    'valeur', cast(r.n1997 as varchar)) as varchar)
from customer c join nation n on n.n_nationkey = c.c_nationkey join region_years r on r.n_regionkey = n.n_regionkey"""


def _warehouse(spark: SparkSession, folder: str) -> str:
    """Metric files of all three territory levels, loaded as facts; gives the store."""
    base = new_folder(spark, "warehouse")
    orders = table(spark, folder, "orders").withColumn(v.YEAR, F.year("o_orderdate"))
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )

    def in_year(year: int) -> Column:
        return F.count(F.when(F.col(v.YEAR) == year, 1))

    by_commune = orders.groupBy(F.col("o_custkey").alias(v.COMMUNE_CODE), v.YEAR).agg(
        F.count(F.lit(1)).alias("orders")
    )
    code = F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")).alias("Code Département")
    by_department = placed.groupBy(F.col("n_name").alias(v.GEO_DEPARTMENT_LABEL), code).agg(
        in_year(1996).alias("Ventes 1996"), in_year(1998).alias("Ventes 1998")
    )
    by_region = placed.groupBy(F.col("n_regionkey").alias(v.REGION), F.col("c_mktsegment").alias(v.INDICATOR)).agg(
        in_year(1997).alias("taux pour mille 1997")
    )
    outputs = {
        "commandes-par-commune": partial(write_delimited, by_commune, f"{base}/outputs/commandes-par-commune.csv", [v.YEAR]),
        "ventes-par-departement": partial(write_delimited, by_department, f"{base}/outputs/pretes/ventes-par-departement.csv"),
        "delits-par-region": partial(write_delimited, by_region, f"{base}/outputs/Security/delits-par-region.csv"),
    }
    run_together(spark, outputs, "output")
    load_dimensions(geography(spark, folder), f"{base}/store")
    load_facts(spark, f"{base}/outputs", f"{base}/store", region_of(spark, folder))
    return base


@query(WAREHOUSE_SQL)
def warehouse_plan(spark: SparkSession, folder: str) -> DataFrame:
    return read_facts(spark, f"{_warehouse(spark, folder)}/store/{v.FACT_TABLE}")


@query(
    f"""
with facts as ({WAREHOUSE_SQL})
select annee, type, "CODGEO", json_extract_string(data, '$.valeur') as valeur,
  json_extract_string(data, '$.indicateur') as indicateur, json_extract_string(data, '$.orders') as orders
from facts"""
)
def warehouse_export(spark: SparkSession, folder: str) -> DataFrame:
    """The facts of each type back as columns."""
    base = _warehouse(spark, folder)
    export_facts(spark, f"{base}/store", f"{base}/exports")
    flat = [read_delimited(spark, f"{base}/exports/{kind}.csv").withColumn(v.TYPE, F.lit(kind)) for kind in KINDS]
    together = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), flat)
    return together.select(v.YEAR, v.TYPE, v.COMMUNE_CODE, "valeur", "indicateur", "orders")


KINDS = ("commandes", "ventes", "delits")


@query(
    f"""
with facts as (
  select o_custkey, c_custkey, c_nationkey, n_nationkey
  from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
)
select 'department key' as name, count(*) as n from (
  select n_nationkey from nation group by n_nationkey having count(*) > 1)
union all select 'commune key', count(*) from (select c_custkey from customer group by c_custkey having count(*) > 1)
union all select 'commune in department', count(distinct c_nationkey) from facts where n_nationkey is null
union all select 'fact in commune', count(distinct o_custkey) from facts where c_custkey is null
union all select 'fact in department', count(distinct c_nationkey) from facts where n_nationkey is null
union all select 'fact types', count(distinct true) from facts where length(cast(o_custkey as varchar)) > 5
union all select 'fact data', count(distinct type) from ({WAREHOUSE_SQL}) where not json_valid(data)"""
)
def warehouse_checks(spark: SparkSession, folder: str) -> DataFrame:
    """How many violations each check of the stored tables finds."""
    broken = check_warehouse(spark, f"{_warehouse(spark, folder)}/store")
    counted = [
        violations.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, violations in broken.items()
    ]
    return reduce(DataFrame.unionByName, counted)
