"""All plans in order: files to outputs, outputs to facts, facts to exports."""

from __future__ import annotations

from pyspark.sql import SparkSession

from armorica import vocabulary as v
from armorica.operators.facts import REGION_OF, regions
from armorica.plans import conversion, elections, indicators, warehouse
from armorica.sinks import write_table
from armorica.sources import read_file


def run_all(spark: SparkSession, inputs: str, outputs: str, store: str, exports: str) -> dict[str, object]:
    """Run every plan on the standard folder layout; gives the rows written per step."""
    done: dict[str, object] = {
        "elections": elections.score_elections(spark, f"{inputs}/{v.ELECTIONS}", f"{outputs}/{v.ELECTIONS}"),
        "yearly": conversion.convert_yearly(spark, inputs, outputs),
    }
    single = {
        "poverty": (indicators.average_poverty, "Pauvrete/2017", v.POVERTY_FILE, v.POVERTY_FILE),
        "education": (
            indicators.share_diplomas,
            "Demographie-NiveauEtude/2022",
            v.EDUCATION_FILE,
            v.EDUCATION_OUTPUT,
        ),
        "crime": (indicators.pivot_crime, "Security", v.CRIME_FILE, v.CRIME_FILE),
        "social index": (indicators.average_social_index, "IndicePositionSociale", v.SOCIAL_FILE, v.SOCIAL_FILE),
    }
    for step, (plan, folder, source, target) in single.items():
        written = plan(spark, f"{inputs}/{folder}/{source}.xlsx", f"{outputs}/{folder}/{target}.csv")
        if written is None:
            written = plan(spark, f"{inputs}/{folder}/{source}.csv", f"{outputs}/{folder}/{target}.csv")
        done[step] = written
    done["ready"] = conversion.convert_tree(spark, f"{inputs}/{v.READY_INPUT}", f"{outputs}/{v.READY_OUTPUT}")

    geography = read_file(spark, f"{inputs}/{v.GEOGRAPHY_FILE}")
    if geography is not None:
        done["dimensions"] = warehouse.load_dimensions(geography, store)
        broken = {name: rows.count() for name, rows in warehouse.check_dimensions(spark, store).items()}
        if any(broken.values()):
            raise ValueError(f"dimensions break their constraints, no facts were loaded: {broken}")
        region_of = REGION_OF
        if (named := regions(geography)) is not None:
            write_table(named, f"{store}/{v.REGION_TABLE}")
            region_of = spark.read.parquet(f"{store}/{v.REGION_TABLE}")
        done["facts"] = warehouse.load_facts(spark, outputs, store, region_of)
        done["unplaced regions"] = warehouse.unplaced_regions(spark, outputs, store, region_of).count()
        done["violations"] = {
            name: broken.count() for name, broken in warehouse.check_warehouse(spark, store).items()
        }
        done["exports"] = warehouse.export_facts(spark, store, exports)
    return done
