"""Tables of a database written over JDBC."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from armorica.sinks.files import counted

# Which runs have been loaded into which tables.
LEDGER = "chargements"


def overwrite_database(
    df: DataFrame, url: str, table: str, ddl: str | None = None, options: Mapping[str, str] | None = None
) -> int:
    """Replace a table, its columns typed by ``ddl``; gives the number of rows written."""
    settings = {**(options or {}), **({"createTableColumnTypes": ddl} if ddl else {})}
    return _write(df, url, table, "overwrite", settings)


def append_database(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None) -> int:
    """Add rows to a table, which is created if it does not exist."""
    return _write(df, url, table, "append", options or {})


def _write(df: DataFrame, url: str, table: str, mode: str, options: Mapping[str, str]) -> int:
    df, seen = counted(df)
    settings = {"url": url, "dbtable": table, **options}
    df.write.format("jdbc").mode(mode).options(**settings).save()
    return seen.get["n"]


class Database:
    """Statements that go to the database itself, over a connection of the driver."""

    def __init__(self, spark: SparkSession, url: str, options: Mapping[str, str] | None = None) -> None:
        self.jvm, self.url, self.options = spark._jvm, url, dict(options or {})

    def quoted(self, name: str) -> str:
        return self.jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier(name)

    def _connect(self):
        if driver := self.options.get("driver"):
            self.jvm.java.lang.Class.forName(driver)
        told = self.jvm.java.util.Properties()
        for name, value in self.options.items():
            told.setProperty(name, str(value))
        return self.jvm.java.sql.DriverManager.getConnection(self.url, told)

    def together(self, statements: Sequence[str]) -> None:
        """All statements in one transaction, or none."""
        connection = self._connect()
        try:
            connection.setAutoCommit(False)
            try:
                for statement in statements:
                    connection.createStatement().executeUpdate(statement)
                connection.commit()
            except Exception:
                connection.rollback()
                raise
        finally:
            connection.close()

    def number(self, query: str) -> int:
        connection = self._connect()
        try:
            found = connection.createStatement().executeQuery(query)
            return found.getLong(1) if found.next() else 0
        finally:
            connection.close()


def load_once(
    df: DataFrame,
    url: str,
    table: str,
    run: str,
    replace: bool = False,
    ddl: str | None = None,
    options: Mapping[str, str] | None = None,
    attempts: int = 3,
    database: Database | None = None,
) -> int:
    """Add the rows to a table, or ``replace`` what it holds, once for each ``run``; the rows loaded, 0 if the run was loaded before.

    Tasks write to a staging table of the run. A task that is repeated after it committed leaves its rows
    twice: the staging table is counted and written anew, ``attempts`` times at the most. Then
    one transaction enters the run in ``chargements`` and moves the rows. Whatever fails before its commit leaves the table
    as it was, and the same run can be started again. Two loads of one run at a time meet at the key of
    ``chargements``, where one fails. The table is created if it does not exist.
    """
    if not re.fullmatch(r"[A-Za-z0-9_]{1,40}", run):
        raise ValueError(f"a run is named by letters, digits and _, at most 40: {run!r}")
    database = database or Database(df.sparkSession, url, options)
    staging, name = f"{table}__{run}", table.replace("'", "''")
    columns = ", ".join(database.quoted(column) for column in df.columns)
    key = "run_id VARCHAR(40) NOT NULL, table_name VARCHAR(200) NOT NULL, PRIMARY KEY (run_id, table_name)"
    database.together([f"CREATE TABLE IF NOT EXISTS {LEDGER} ({key})"])
    if database.number(f"SELECT COUNT(*) FROM {LEDGER} WHERE run_id = '{run}' AND table_name = '{name}'"):
        database.together([f"DROP TABLE IF EXISTS {staging}"])
        return 0
    settings = {**(options or {}), **({"createTableColumnTypes": ddl} if ddl else {})}
    for _ in range(attempts):
        written = _write(df, url, staging, "overwrite", settings)
        held = database.number(f"SELECT COUNT(*) FROM {staging}")
        if held == written:
            break
    else:
        raise RuntimeError(f"{staging} holds {held} rows, {written} were written")
    _write(df.limit(0), url, table, "append", settings)
    database.together(
        [
            f"INSERT INTO {LEDGER} (run_id, table_name) VALUES ('{run}', '{name}')",
            *([f"DELETE FROM {table}"] if replace else []),
            f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}",
        ]
    )
    database.together([f"DROP TABLE IF EXISTS {staging}"])
    return written
