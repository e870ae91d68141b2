"""Compare Spark rows with the rows DuckDB gives for the equivalent SQL.

Run as a script: ``python tests/compare.py <folder of tables> [query ...]``.
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def plain(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return f"float {value!r}"
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return f"{type(value).__name__} {value}"


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark_frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    ours = rows_of(spark_frame.columns, [tuple(row) for row in spark_frame.collect()])
    cursor = connection.execute(sql)
    names = [item[0] for item in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(spark_frame.columns) != sorted(names):
        return f"columns {sorted(spark_frame.columns)} and {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows; {ours[:2]} and {theirs[:2]}"
    wrong = [(one, other) for one, other in zip(ours, theirs) if one != other]
    return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from armorica.queries import QUERIES

    folder, wanted = sys.argv[1], sys.argv[2:]
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    spark = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name, query in QUERIES.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = query.run(spark, folder)
            wrong = difference(frame, connection, query.sql) if query.sql else None
        except Exception as error:  # noqa: BLE001
            wrong = f"{type(error).__name__}: {str(error)[:600]}"
        failed += wrong is not None
        print(f"{'ok  ' if wrong is None else 'FAIL'} {name} {time.time() - start:.1f}s {wrong or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
