"""Drivers that die between any two steps, and writers that race for one target."""

import threading
from datetime import timedelta
from pathlib import Path

import pytest
from conftest import AMERICA, EUROPE, rows
from pyspark.sql import SparkSession

from partloom import apas, apas_many, ctas, drop_partition, recover
from partloom.errors import AlreadyExists, Busy, ConfigError
from partloom.plans import journal
from partloom.sources import storage
from partloom.sources.catalog import TableName, describe_table
from partloom.sources.storage import has_objects

NOW = timedelta(0)
NEW = [(9, 1, 7), (8, 3, 6), (7, 4, 2)]


class Off(BaseException):
    """The driver is gone: nothing has an effect any more."""


class Power:
    """Lets some effects happen, on files or on the catalog, and none after them."""

    def __init__(self, monkeypatch, steps):
        self.left = steps
        opened, made, sql = storage._open, storage.create_new, SparkSession.sql

        def gated(call, *given, **options):
            if self.left <= 0:
                raise Off
            self.left -= 1
            return call(*given, **options)

        class Files:
            def __init__(self, fs):
                self._fs = fs

            def __getattr__(self, name):
                call = getattr(self._fs, name)
                return (lambda *given: gated(call, *given)) if name in ("rename", "delete", "mkdirs") else call

        def open_(spark, uri):
            fs, path = opened(spark, uri)
            return Files(fs), path

        def create(spark, uri, text):
            return gated(made, spark, uri, text)

        def run(spark, text, *given, **options):
            if text.lstrip().split(" ", 1)[0] in ("ALTER", "CREATE", "DROP"):
                return gated(sql, spark, text, *given, **options)
            return sql(spark, text, *given, **options)

        monkeypatch.setattr(storage, "_open", open_)
        for module in (storage, journal):
            monkeypatch.setattr(module, "create_new", create)
        monkeypatch.setattr(SparkSession, "sql", run)


def left_behind(spark, db, folder):
    files = [p.name for p in Path(folder.removeprefix("file:")).rglob("_*") if not p.name.startswith(("_SUCCESS", "_run=", "_places."))]
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()]
    return files + [t for t in tables if t.startswith(("scratch", "replaced"))]


WRITES = {
    "apas": lambda spark, db, folder: apas(spark, "select 8 as a", database=db, table="small", partition_kv={"b": "3", "c": "6"}),
    "apas new": lambda spark, db, folder: apas(spark, "select 7 as a", database=db, table="small", partition_kv={"b": "4", "c": "2"}),
    "apas relocated": lambda spark, db, folder: apas(
        spark, "select 8 as a", database=db, table="small", partition_kv={"b": "3", "c": "6"}, relocate=True
    ),
    "apas emptied": lambda spark, db, folder: apas(
        spark, "select 8 as a where false", database=db, table="small", partition_kv={"b": "3", "c": "6"}
    ),
    "many": lambda spark, db, folder: many(spark, db),
    "many relocated": lambda spark, db, folder: many(spark, db, relocate=True),
    "ctas": lambda spark, db, folder: overwrite(spark, db, folder),
    "ctas relocated": lambda spark, db, folder: overwrite(spark, db, folder, relocate=True),
    "ctas empty": lambda spark, db, folder: overwrite(spark, db, folder, table_mode="empty"),
    "ctas elsewhere": lambda spark, db, folder: overwrite(spark, db, folder, at="other"),
}
AFTER = {
    "apas": [AMERICA, (8, 3, 6)],
    "apas new": [AMERICA, EUROPE, (7, 4, 2)],
    "apas relocated": [AMERICA, (8, 3, 6)],
    "apas emptied": [AMERICA],
    "many": sorted(NEW),
    "many relocated": sorted(NEW),
    "ctas": [(9, 1, 7)],
    "ctas relocated": [(9, 1, 7)],
    "ctas empty": [],
    "ctas elsewhere": [(9, 1, 7)],
}


def many(spark, db, **options):
    values = ", ".join(map(str, NEW))
    return apas_many(spark, f"select cast(a as int) a, b, c from values {values} as t(a, b, c)", database=db, table="small", **options)


def overwrite(spark, db, folder, at="small", **options):
    select = "select cast(9 as int) as a, 1 as b, 7 as c"
    return ctas(spark, select, database=db, table="small", location=f"{folder}{at}", partitioned_by=["b", "c"], **options)


def values_of(spark, db):
    spark.catalog.refreshTable(f"{db}.small")
    return sorted(rows(spark.table(f"{db}.small")))


@pytest.mark.parametrize("write", WRITES)
def test_a_driver_that_dies_between_any_two_steps(spark, small, db, folder, monkeypatch, write):
    old, new, seen = sorted([AMERICA, EUROPE]), sorted(AFTER[write]), set()
    # Every step of the calls at the heart of it, every third of the others.
    for steps in range(1, 200, 1 if write in ("many", "apas", "ctas") else 3):
        with monkeypatch.context() as patched:
            power = Power(patched, steps)
            try:
                WRITES[write](spark, db, folder)
                done = True
            except Off:
                done = False
            finished = done and power.left > 0
        if not done:
            told = recover(spark, database=db, table="small", location=f"{folder}small", silent_for=NOW)
            assert {r.outcome for r in told.collect()} <= {"old", "new"}
        assert left_behind(spark, db, folder) == []
        now = values_of(spark, db)
        assert now in (old, new), (steps, now)
        seen.add(tuple(now))
        if finished:
            break
        # Back to the start, through the operators themselves.
        if now != old:
            select = f"select * from values {AMERICA}, {EUROPE} as t(a, b, c)"
            ctas(spark, select, database=db, table="small", location=f"{folder}small", partitioned_by=["b", "c"])
    assert finished and seen == {tuple(old), tuple(new)}


def test_a_managed_table_goes_forward(spark, db, folder, monkeypatch):
    for steps in range(3, 60, 2):
        spark.sql(f"DROP TABLE IF EXISTS {db}.small")
        spark.sql(f"CREATE TABLE {db}.small USING parquet PARTITIONED BY (b, c) AS SELECT * FROM VALUES (5, 1, 7) AS t(a, b, c)")
        place = describe_table(spark, TableName(db, "small")).location
        with monkeypatch.context() as patched:
            Power(patched, steps)
            try:
                ctas(spark, "select cast(9 as int) as a, 1 as b, 7 as c", database=db, table="small", location=place, partitioned_by=["b", "c"])
                done = True
            except Off:
                done = False
        if not done:
            recover(spark, database=db, table="small", location=place, silent_for=NOW)
        assert left_behind(spark, db, folder) == [] and values_of(spark, db) in ([AMERICA], [(9, 1, 7)]), steps
        if done:
            break
        spark.sql(f"DROP TABLE IF EXISTS {db}.small")
        storage.delete_tree(spark, place)
    assert done and values_of(spark, db) == [(9, 1, 7)]


def test_a_call_that_lives_is_let_be(spark, small, db, folder):
    place = describe_table(spark, TableName(db, "small")).location
    with journal.writing(spark, [place], what="it"):
        told = recover(spark, database=db, table="small")
        assert [(r.what, r.outcome) for r in told.collect()] == [("it", "alive")]
        with pytest.raises(Busy):
            WRITES["apas"](spark, db, folder)
        with pytest.raises(Busy):
            overwrite(spark, db, folder)
    WRITES["apas"](spark, db, folder)
    assert left_behind(spark, db, folder) == [] and recover(spark, database=db).count() == 0
    with pytest.raises(ConfigError):
        recover(spark, database="nowhere")


def test_the_whole_is_refused_while_a_part_is_written(spark, small, db, folder):
    info = describe_table(spark, TableName(db, "small"))
    with journal.writing(spark, [f"{info.location}b=3/c=6/"], within=info.location, what="it"):
        for refused in ("many", "ctas", "apas"):
            with pytest.raises(Busy):
                WRITES[refused](spark, db, folder)
        WRITES["apas new"](spark, db, folder)
    assert values_of(spark, db) == sorted([AMERICA, EUROPE, (7, 4, 2)]) and left_behind(spark, db, folder) == []


def test_a_call_that_was_taken_for_dead_stops(spark, small, db, folder):
    with pytest.raises(Busy):
        with journal.writing(spark, [f"{folder}small"], what="it") as mine:
            recover(spark, database=db, table="small", silent_for=NOW)
            mine.require_lease()


def race(spark, calls):
    """What each of the calls, all begun at once, came to."""
    start, outcomes = threading.Barrier(len(calls)), [None] * len(calls)

    def run(i):
        start.wait()
        try:
            calls[i]()
            outcomes[i] = "done"
        except Busy:
            outcomes[i] = "busy"
        except BaseException as error:  # noqa: BLE001
            outcomes[i] = repr(error)

    threads = [threading.Thread(target=storage.inheriting(spark, run), args=(i,)) for i in range(len(calls))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return outcomes


@pytest.mark.parametrize("relocate", [False, True])
def test_two_writers_of_one_partition(spark, small, db, folder, relocate):
    for i in range(8):
        def store(value):
            apas(spark, f"select {value} as a", database=db, table=small, partition_kv={"b": "3", "c": "6"}, relocate=relocate)

        told = race(spark, [lambda: store(2 * i), lambda: store(2 * i + 1)])
        assert set(told) <= {"done", "busy"} and "done" in told
        now = [r for r in values_of(spark, db) if r[1] == 3]
        assert now in ([(2 * i, 3, 6)], [(2 * i + 1, 3, 6)])
        if "busy" in told:
            assert now == [(2 * i + told.index("done"), 3, 6)]
    assert left_behind(spark, db, folder) == []


def test_a_writer_of_all_and_one_of_a_part(spark, small, db, folder):
    for _ in range(5):
        told = race(spark, [lambda: many(spark, db), lambda: WRITES["apas"](spark, db, folder)])
        assert set(told) <= {"done", "busy"}
        if "done" in told:
            assert values_of(spark, db) in (sorted(NEW), sorted([AMERICA, (8, 3, 6)]))
    assert left_behind(spark, db, folder) == []


def test_leases_are_created_once(spark, folder):
    for i in range(20):
        told = race(spark, [lambda: taken.append(storage.create_new(spark, f"{folder}deep/{i}/lease", "x"))] * 6) if (taken := []) == [] else None
        assert set(told) == {"done"} and sum(taken) == 1


# --- many partitions from one SELECT ----------------------------------------------


def test_many_partitions_from_one_scan(spark, small, db, folder, monkeypatch):
    ran = []
    from partloom.operators.ctas import Write

    kept = Write._create
    monkeypatch.setattr(Write, "_create", lambda self, *given: (ran.append(self.rows._jdf.queryExecution().toString()), kept(self, *given)))
    source = f"{folder}source"
    spark.sql("select * from values (1, 4, 2), (2, 4, 2), (3, 3, 6) as t(a, b, c)").write.parquet(source)
    told = apas_many(spark, f"select c, a, b from parquet.`{source}`", database=db, table=small)
    assert rows(told) == [("3", "6", f"{folder}small/b=3/c=6/", "stored"), ("4", "2", f"{folder}small/b=4/c=2/", "stored")]
    assert values_of(spark, db) == sorted([AMERICA, (1, 4, 2), (2, 4, 2), (3, 3, 6)])
    assert len(ran) == 1 and ran[0].split("Physical Plan")[1].count("FileScan parquet") == 1


def test_expected_partitions_without_rows_go(spark, small, db, folder):
    spec = [{"b": "3", "c": "6"}, {"b": "8", "c": "8"}, {"b": "1", "c": "7"}]
    told = apas_many(spark, "select 4 as a, 1 as b, 7 as c", database=db, table=small, expected=spec)
    assert rows(told, "b", "action") == [("1", "stored"), ("3", "empty"), ("8", "empty")]
    assert values_of(spark, db) == [(4, 1, 7)] and not has_objects(spark, f"{folder}small/b=3")
    assert left_behind(spark, db, folder) == []


def test_save_modes_of_many(spark, small, db, folder):
    with pytest.raises(AlreadyExists):
        many(spark, db, save_mode="error_if_exists")
    assert values_of(spark, db) == sorted([AMERICA, EUROPE])
    for relocate in (False, True):
        told = many(spark, db, save_mode="skip_if_exists", relocate=relocate)
        assert sorted(rows(told, "b", "action"))[:2] == [("1", "kept"), ("3", "kept")]
        assert values_of(spark, db) == sorted([AMERICA, EUROPE, (7, 4, 2)])
        drop_partition(spark, database=db, table=small, partition_kv={"b": "4", "c": "2"}, with_location=True)
    assert left_behind(spark, db, folder) == []


def test_many_is_refused(spark, small, db, folder):
    with pytest.raises(ConfigError, match="keys"):
        apas_many(spark, "select 1 as a, 1 as b", database=db, table=small)
    from partloom.errors import SchemaMismatch

    with pytest.raises(SchemaMismatch):
        apas_many(spark, "select 'x' as a, 1 as b, 2 as c", database=db, table=small)
    assert values_of(spark, db) == sorted([AMERICA, EUROPE]) and left_behind(spark, db, folder) == []


def test_null_keys_odd_values_and_no_rows(spark, db, folder):
    ctas(spark, "select 1 as a, 'x' as k", database=db, table="small", location=f"{folder}small", partitioned_by=["k"])
    odd = ["a=b/c d", "Ä%:", None, "x"]
    values = ", ".join(f"({i}, {'null' if k is None else repr(k)})" for i, k in enumerate(odd))
    for relocate in (False, True, False):
        apas_many(spark, f"select cast(a as int) a, k from values {values} as t(a, k)", database=db, table="small", relocate=relocate)
        assert rows(spark.table(f"{db}.small"), "a", "k") == [(i, k) for i, k in enumerate(odd)]
    assert apas_many(spark, "select 1 as a, 'x' as k where false", database=db, table="small").count() == 0
    assert rows(spark.table(f"{db}.small"), "a", "k") == [(i, k) for i, k in enumerate(odd)]


@pytest.mark.parametrize("step", ["add", "move", "rename"])
def test_many_all_or_nothing(spark, small, db, folder, monkeypatch, step):
    module = __import__("sys").modules["partloom.operators.apas"]

    def fail(*_):
        raise RuntimeError("refused")

    with monkeypatch.context() as patched:
        if step == "rename":
            kept, count = storage._rename, []
            patched.setattr(storage, "_rename", lambda fs, a, b: fail() if len(count) == 3 and not count.append(1) else (count.append(1), kept(fs, a, b)))
        else:
            patched.setattr(module, {"add": "add_to_catalog", "move": "move_in_catalog"}[step], fail)
        with pytest.raises(RuntimeError):
            many(spark, db, relocate=step == "move")
    assert values_of(spark, db) == sorted([AMERICA, EUROPE]) and left_behind(spark, db, folder) == []
    many(spark, db)
    assert values_of(spark, db) == sorted(NEW)
