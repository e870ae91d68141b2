"""Run all plans: ``spark-submit`` or ``python -m armorica <inputs> <outputs> <store> <exports>``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from armorica.plans import run_all


def main() -> None:
    parser = argparse.ArgumentParser(prog="armorica", description=__doc__)
    parser.add_argument("inputs", help="folder of source files, one folder per dataset")
    parser.add_argument("outputs", help="folder for cleaned and aggregated files")
    parser.add_argument("store", help="folder for dimension and fact tables")
    parser.add_argument("exports", help="folder for facts flattened by type and year")
    places = parser.parse_args()
    spark = SparkSession.builder.appName("armorica").getOrCreate()
    for step, written in run_all(spark, places.inputs, places.outputs, places.store, places.exports).items():
        print(f"{step}: {written}")
    spark.stop()


if __name__ == "__main__":
    main()
