"""Loads into a database, once for each run: the order of statements, repeated tasks and failures, without a database."""

from __future__ import annotations

import pytest

from armorica import vocabulary as v
from armorica.plans import publish
from armorica.sinks import database as sink
from armorica.sinks import load_once, write_facts, write_table


class Fake:
    """Counts of rows by table; statements in the order in which they were committed."""

    def __init__(self, doubled=0, fails_at=None):
        self.rows, self.runs, self.said, self.doubled, self.fails_at = {}, set(), [], doubled, fails_at

    def quoted(self, name):
        return f'"{name}"'

    def together(self, statements):
        if self.fails_at and any(statement.startswith(self.fails_at) for statement in statements):
            self.fails_at = None
            raise OSError("connection lost")
        for statement in statements:
            self.said.append(statement)
            words = statement.split()
            if statement.startswith("INSERT INTO chargements"):
                assert statement not in self.runs, "the key refuses a second one"
                self.runs.add(statement)
            elif statement.startswith("INSERT INTO"):
                self.rows[words[2]] = self.rows.get(words[2], 0) + self.rows[words[-1]]
            elif statement.startswith("DELETE FROM"):
                self.rows[words[2]] = 0
            elif statement.startswith("DROP TABLE"):
                self.rows.pop(words[-1], None)

    def number(self, query):
        if "chargements" in query:
            run, table = query.split("'")[1::2]
            return sum(f"('{run}', '{table}')" in statement for statement in self.runs)
        return self.rows[query.split()[-1]]

    def write(self, df, url, table, mode, options):
        n = df.count()
        self.said.append(f"{mode} {table} {n}")
        again = n if mode == "overwrite" and self.doubled else 0
        self.doubled -= 1 if again else 0
        self.rows[table] = n + again + (self.rows.get(table, 0) if mode == "append" else 0)
        return n


@pytest.fixture
def fake(monkeypatch):
    def make(**how):
        made = Fake(**how)
        monkeypatch.setattr(sink, "_write", made.write)
        monkeypatch.setattr(sink, "Database", lambda *_: made)
        return made

    return make


def test_order_of_statements(spark, fake):
    told = fake()
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, `the name` string")
    assert load_once(rows, "jdbc:x", "things", "r1", replace=True) == 2
    assert [statement.split(" (run_id VARCHAR")[0] for statement in told.said] == [
        "CREATE TABLE IF NOT EXISTS chargements",
        "overwrite things__r1 2",
        "append things 0",
        "INSERT INTO chargements (run_id, table_name) VALUES ('r1', 'things')",
        "DELETE FROM things",
        'INSERT INTO things ("id", "the name") SELECT "id", "the name" FROM things__r1',
        "DROP TABLE IF EXISTS things__r1",
    ]


def test_a_run_is_loaded_once(spark, fake):
    told = fake()
    rows = spark.range(3)
    assert [load_once(rows, "jdbc:x", "things", run) for run in ("r1", "r1", "r2")] == [3, 0, 3]
    assert told.rows == {"things": 6}
    assert load_once(rows.limit(0), "jdbc:x", "things", "r3", replace=True) == 0 and told.rows == {"things": 0}


def test_rows_of_repeated_tasks_are_not_loaded(spark, fake):
    told = fake(doubled=2)
    assert load_once(spark.range(3), "jdbc:x", "things", "r1") == 3 and told.rows == {"things": 3}
    told = fake(doubled=5)
    with pytest.raises(RuntimeError, match="things__r1 holds 6 rows, 3 were written"):
        load_once(spark.range(3), "jdbc:x", "things", "r1")
    assert "things" not in told.rows and not told.runs


@pytest.mark.parametrize("where", ["INSERT INTO chargements", "DROP TABLE"])
def test_a_failed_run_can_be_started_again(spark, fake, where):
    told = fake(fails_at=where)
    with pytest.raises(OSError):
        load_once(spark.range(3), "jdbc:x", "things", "r1")
    load_once(spark.range(3), "jdbc:x", "things", "r1")
    assert told.rows == {"things": 3}


def test_names_of_runs(spark, fake):
    fake()
    for run in ("", "a b", "x'; drop", "r" * 41):
        with pytest.raises(ValueError):
            load_once(spark.range(1), "jdbc:x", "things", run)


def test_transactions_are_whole():
    said = []

    class Connection:
        def createStatement(self):
            return self

        def executeUpdate(self, statement):
            said.append(statement)
            if statement == "bad":
                raise OSError

        def __getattr__(self, name):
            return lambda *of: said.append((name, *of))

    base = object.__new__(sink.Database)
    base._connect = Connection
    base.together(["a", "b"])
    with pytest.raises(OSError):
        base.together(["a", "bad", "c"])
    assert said == [("setAutoCommit", False), "a", "b", ("commit",), ("close",), ("setAutoCommit", False), "a", "bad", ("rollback",), ("close",)]


def test_publish_once(spark, fake, tmp_path):
    told = fake()
    for name in (v.DEPARTMENT_TABLE, v.COMMUNE_TABLE):
        write_table(spark.range(2), str(tmp_path / name))
    facts = spark.createDataFrame([(1, "x", 2017)], f"id int, `{v.TYPE}` string, `{v.YEAR}` int")
    write_facts(facts, str(tmp_path / v.FACT_TABLE))
    for run, n in (("a", (2, 2, 1)), ("a", (0, 0, 0)), ("b", (2, 2, 1))):
        assert tuple(publish(spark, str(tmp_path), "jdbc:x", run=run).values()) == n
    assert told.rows == {v.DEPARTMENT_TABLE: 2, v.COMMUNE_TABLE: 2, v.FACT_TABLE: 2}


def test_names_are_quoted_by_the_dialect(spark):
    base = sink.Database(spark, "jdbc:mysql://nowhere/x")
    assert base.quoted("a b") == "`a b`"
