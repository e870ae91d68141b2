"""Plans that hold at scale: no pair-wise joins, pushed filters, split hot keys, no lost rows."""

from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import functions as F

from armorica import vocabulary as v
from armorica.operators.cleaning import keep_slice
from armorica.operators.facts import fan_out_departments, join_communes, join_dimension
from armorica.operators.geography import keep_codes, keep_territory
from armorica.operators.scores import camp_scores_long, camp_scores_wide
from armorica.operators.statistics import mean_by_territory, pivot_years
from armorica.queries import QUERIES
from armorica.sinks import read_facts, write_facts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.mark.parametrize("name", QUERIES)
def test_no_pairwise_join_and_no_python(spark, tables, name):
    text = plan(QUERIES[name].run(spark, tables))
    assert not re.search("NestedLoop|Cartesian", text)
    if name != "workbook_roundtrip":
        assert not re.search("Python|InPandas", text)


def test_scan_reads_only_needed_columns(spark, tables):
    text = plan(QUERIES["camp_score_long"].run(spark, tables))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {
        "l_orderkey",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
    }


def test_whole_number_codes_are_filtered_in_the_scan(spark, tables):
    customers = spark.read.parquet(f"{tables}/customer.parquet")
    text = plan(keep_codes(customers, "c_nationkey", [3, 7]))
    assert "PushedFilters: [In(c_nationkey, [3,7])]" in text
    renamed = customers.withColumnRenamed("c_nationkey", v.DEPARTMENT)
    assert "PushedFilters: [In(c_nationkey, [3,7])]" in plan(keep_territory(renamed, departments=[3, 7]))


def test_fact_slice_reads_its_folder_only(spark, tmp_path):
    schema = f"`{v.COMMUNE_CODE}` string, `{v.COMMUNE_LABEL}` string, `{v.DEPARTMENT}` int, annee int, type string, data string"
    facts = spark.createDataFrame([("1", "a", 22, year, kind, "{}") for year in (2017, 2018) for kind in "ab"], schema)
    write_facts(facts, str(tmp_path / "facts"))
    sliced = keep_slice(read_facts(spark, str(tmp_path / "facts")), {v.YEAR: 2017, v.TYPE: "a"})
    assert sliced.count() == 1
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan(sliced)).group(1)
    assert "annee" in filters and "type" in filters
    # Facts are stored without a shuffle.
    assert "Exchange" not in plan(facts)


def test_fact_load_has_no_shuffle(spark, tables, monkeypatch):
    plans = []

    def write(df, path, mode):
        plans.append(plan(df))
        return write_facts(df, path, mode)

    monkeypatch.setattr("armorica.plans.warehouse.write_facts", write)
    QUERIES["warehouse_plan"].run(spark, tables)
    assert len(plans) == 1 and "Exchange hashpartitioning" not in plans[0]
    assert not re.search("NestedLoop|Cartesian|SinglePartition", plans[0])


def test_one_shuffle_after_partial_aggregation(spark):
    df = spark.range(100).selectExpr("cast(id % 3 as string) k", "cast(id as string) x", "cast(2017 + id % 2 as int) annee")
    for result in (mean_by_territory(df, ["k"], "x", "m"), pivot_years(df, ["k"], "x", (2017, 2018), number="double")):
        text = plan(result)
        assert text.count("Exchange hashpartitioning") == 1
        assert "partial_" in text and "SortAggregate" not in text


def test_camp_lookup_is_computed_once(spark, tables):
    """Seven candidates share one broadcast."""
    scores = QUERIES["camp_score_wide"].run(spark, tables)
    scores.collect()
    after = plan(scores).split("Initial Plan")[0]
    assert after.count("ReusedExchange") == 6
    assert after.count("LocalTableScan") == 1


@pytest.fixture
def small_partitions(settings):
    """Thresholds that make adaptive execution treat test data as large."""
    settings(
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__advisoryPartitionSizeInBytes="16k",
        adaptive__coalescePartitions__enabled="false",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="32k",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )


def hot(spark, n=60_000):
    """A third of the rows on one code, the others spread."""
    code = F.when(F.col("id") % 3 == 0, F.lit("00001")).otherwise(F.lpad((F.col("id") % 500).cast("string"), 5, "0"))
    return spark.range(0, n, 1, 16).select(code.alias("code"), F.col("id").alias("x"))


def dimension(spark):
    return spark.range(500).select(
        F.lpad(F.col("id").cast("string"), 5, "0").alias("code_com"),
        F.lit("n").alias("nom_com"),
        F.lit("p").alias("geo_point"),
        (F.col("id") % 7).cast("int").alias("code_dep"),
    )


def test_hot_commune_is_split_beyond_the_broadcast_bound(spark, small_partitions):
    metrics = hot(spark).withColumnRenamed("code", v.COMMUNE_CODE)
    joined = join_communes(metrics, dimension(spark), small=False)
    text = final_plan(joined)
    assert "SortMergeJoin(skew=true)" in text
    assert joined.count() == 60_000
    assert joined.agg(F.sum("x")).first()[0] == sum(range(60_000))
    assert "BroadcastHashJoin" in plan(join_communes(metrics, dimension(spark), small=True))


def jobs_of(spark, build):
    """What ``build`` gives, and how many jobs ran meanwhile."""
    context = spark.sparkContext
    context.setJobGroup("building", "building")
    try:
        return build(), len(context.statusTracker().getJobIdsForGroup("building"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_joins_start_no_job_when_built(spark):
    places = dimension(spark)
    of_region = places.select("code_dep", (F.col("code_dep") % 2).alias("code_region")).distinct()
    for header in (v.COMMUNE_CODE, v.DEPARTMENT, v.REGION):
        metrics = spark.range(9).select(F.col("id").cast("string").alias(header), F.lit(1).alias("x"))
        assert jobs_of(spark, lambda: join_dimension(metrics, places, of_region))[1] == 0
    codes = spark.range(5)
    rows = spark.range(9).select(F.col("id").cast("string").alias(v.DEPARTMENT))
    kept, jobs = jobs_of(spark, lambda: keep_territory(rows, codes))
    assert jobs == 0 and kept.count() == 5


def ballots(spark, n=6_000):
    """Rows of three candidates, each row twice, a third of the first ones on one code."""
    row = spark.range(0, n, 1, 8).select((F.col("id") / 2).cast("bigint").alias("id"))
    first = F.when(F.col("id") % 3 == 0, "L1").otherwise(F.concat(F.lit("R"), F.col("id") % 50))
    return row.select(
        F.col("id").alias("place"),
        first.alias(f"{v.CANDIDATE_PREFIX}1"),
        F.lit("10,00%").alias(f"{v.VOTE_SHARE_PREFIX}1"),
        F.when(F.col("id") % 7 == 0, None).otherwise("L1").alias(f"{v.CANDIDATE_PREFIX}2"),
        F.lit("20,50%").alias(f"{v.VOTE_SHARE_PREFIX}2"),
        F.lit("unknown").alias(f"{v.CANDIDATE_PREFIX}3"),
        F.when(F.col("id") % 5 == 0, "30%").alias(f"{v.VOTE_SHARE_PREFIX}3"),
    )


@pytest.mark.parametrize("copies_at_once", [1, 10_000])
def test_wide_scores_beyond_the_bound_join_once(spark, small_partitions, monkeypatch, copies_at_once):
    monkeypatch.setattr("armorica.operators.scores.COPIES_AT_ONCE", copies_at_once)
    camps = spark.range(1, 51).selectExpr("concat('R', id) Code", "'Droite' Orientation")
    camps = camps.unionByName(spark.sql("select * from values ('L1', 'Gauche') as t(Code, Orientation)"))
    rows = ballots(spark)
    near = camp_scores_wide(rows, camps, keep=["place"])
    far = camp_scores_wide(rows, camps, keep=["place"], max_bytes=0)
    assert sorted(near.collect()) == sorted(far.collect())
    assert far.count() == 6_000
    text = plan(far).split("Initial Plan")[0]
    assert text.count("SortMergeJoin") == 1
    # Two over the votes, one over the reference.
    assert text.count("Exchange hashpartitioning") <= 3


def test_wide_scores_beyond_the_bound_do_not_multiply_rows(spark, small_partitions):
    """A row per candidate is made of each different list of codes, not of each row; a hot list is split."""
    camps = spark.sql("select * from values (2017, 'A', 'Gauche'), (2017, 'B', 'Droite'), (2022, 'B', 'Gauche') as t(annee, Code, Orientation)")
    first = F.when(F.col("id") % 3 < 2, "A").when(F.col("id") % 9 == 2, F.concat(F.lit("C"), F.col("id")))
    rows = spark.range(0, 60_000, 1, 16).select(
        F.col("id").alias("place"),
        F.when(F.col("id") % 3 < 2, 2017).when(F.col("id") % 9 == 5, 2022).alias("annee"),
        first.alias(f"{v.CANDIDATE_PREFIX}1"),
        F.when(F.col("id") % 11 != 0, "10,25%").alias(f"{v.VOTE_SHARE_PREFIX}1"),
        F.lit("B").alias(f"{v.CANDIDATE_PREFIX}2"),
        F.lit("20%").alias(f"{v.VOTE_SHARE_PREFIX}2"),
    )
    far = camp_scores_wide(rows, camps, by=["annee"], keep=["place"], max_bytes=0)
    near = camp_scores_wide(rows, camps, by=["annee"], keep=["place"])
    assert sorted(far.collect(), key=str) == sorted(near.collect(), key=str)
    text = final_plan(far).split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in text
    assert not re.search("Generate|Aggregate", text)


def test_lists_of_codes_within_the_bound_of_spark_are_joined_without_a_shuffle(spark):
    camps = spark.sql("select * from values ('L1', 'Gauche'), ('R1', 'Droite') as t(Code, Orientation)")
    far = camp_scores_wide(ballots(spark), camps, keep=["place"], max_bytes=0)
    assert "Exchange hashpartitioning" not in final_plan(far)
    assert sorted(far.collect()) == sorted(camp_scores_wide(ballots(spark), camps, keep=["place"]).collect())


def test_rows_that_change_between_two_reads_are_refused(spark):
    """Never scored as candidates without a camp."""
    camps = spark.sql("select * from values ('L1', 'Gauche') as t(Code, Orientation)")
    header = f"`{v.CANDIDATE_PREFIX}1` string, `{v.VOTE_SHARE_PREFIX}1` string"
    # Another code whenever the rows are computed.
    changing = spark.sparkContext.parallelize(range(3)).map(lambda _: (str(time.time_ns()), "1%"))
    rows = spark.createDataFrame(changing, header)
    with pytest.raises(Exception, match="other codes"):
        camp_scores_wide(rows, camps, max_bytes=0).collect()


def test_hot_department_is_split_beyond_the_broadcast_bound(spark, small_partitions):
    places = hot(spark).select(
        F.col("x").cast("string").alias("code_com"), F.col("code").cast("int").alias("code_dep")
    )
    metrics = spark.range(500).select(F.col("id").cast("string").alias(v.DEPARTMENT), F.lit(1).alias("y"))
    fanned = fan_out_departments(metrics, places)
    assert "SortMergeJoin(skew=true)" in final_plan(fanned)
    assert fanned.count() == 60_000


def test_hot_code_of_a_long_list_is_split(spark, small_partitions):
    rows = hot(spark).withColumnRenamed("code", v.DEPARTMENT)
    kept = keep_codes(rows, v.DEPARTMENT, spark.range(0, 250))
    assert "skew=true" in final_plan(kept)
    assert kept.count() == rows.filter(F.col(f"`{v.DEPARTMENT}`").cast("int") < 250).count()


@pytest.mark.parametrize("max_bytes", [0, 10**6])
def test_hot_code_and_hot_territory(spark, small_partitions, max_bytes):
    """One territory with a third of the votes, all of them for one code."""
    votes = hot(spark).select(
        F.when(F.col("code") == "00001", 1).otherwise(F.col("x") % 100).alias("place"),
        F.when(F.col("code") == "00001", "L").otherwise("R").alias("code"),
        F.lit("0,01%").alias("share"),
    )
    camps = spark.sql("select * from values ('L', 'Gauche'), ('R', 'Droite') as t(Code, Orientation)")
    scores = camp_scores_long(votes, ["place"], "code", "share", camps, max_bytes=max_bytes)
    counted = votes.groupBy("place", "code").count().collect()
    expected = {}
    for place, code, n in counted:
        expected.setdefault(place, {"L": 0, "R": 0})[code] = n / 100
    for row in scores.collect():
        assert row[v.SCORE_LEFT] == pytest.approx(expected[row["place"]]["L"])
        assert row[v.SCORE_RIGHT] == pytest.approx(expected[row["place"]]["R"])
    if max_bytes == 0:
        # Votes are combined per territory and code before they meet the lookup.
        text = plan(scores)
        assert text.rindex("partial_sum") > text.index("Join")
