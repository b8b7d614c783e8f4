from datetime import timedelta
from pathlib import Path

import pytest
from conftest import AMERICA, EUROPE, rows

from partloom import apas, ctas
from partloom.errors import AlreadyExists, ConfigError, QueryTimeout, SchemaMismatch
from partloom.sources.storage import has_objects

SPEC = {"b": "3", "c": "6"}
NEW = {"b": "9", "c": "10"}


@pytest.fixture
def store(spark, db, small):
    def call(select, partition_kv, **options):
        frame = apas(spark, select, database=db, table=small, partition_kv=partition_kv, **options)
        return frame.first().action

    return call


@pytest.fixture
def held(spark, db, small):
    return lambda: rows(spark.table(f"{db}.{small}"))


def tidy(folder):
    return not [p for p in Path(folder.removeprefix("file:")).rglob("_*-*") if "_SUCCESS" not in p.name]


# --- preconditions ---


def test_database_table_and_keys_must_be_there(spark, db, small):
    def call(**options):
        apas(spark, "select 1 as a", **{"database": db, "table": small, "partition_kv": SPEC, **options})

    with pytest.raises(ConfigError, match="database nowhere does not exist"):
        call(database="nowhere")
    with pytest.raises(ConfigError, match="nowhere does not exist"):
        call(table="nowhere")
    ctas(spark, "select 1 as a", database=db, table="plain")
    with pytest.raises(ConfigError, match="not partitioned"):
        call(table="plain")
    with pytest.raises(ConfigError, match="'c'"):
        call(partition_kv={"b": "3"})
    with pytest.raises(ConfigError, match="save_mode"):
        call(save_mode="ignore")
    with pytest.raises(ConfigError, match="bucket_count"):
        call(bucketed_by=["a"])


def test_extra_keys_are_ignored_and_order_is_that_of_the_table(store, held):
    assert store("select 7 as a", {"x": "1", "c": "10", "b": "9"}) == "stored"
    assert (7, 9, 10) in held()


# --- storing ---


def test_location_is_generated_like_spark_does(spark, db, small, store, folder):
    frame = apas(spark, "select 7 as a", database=db, table=small, partition_kv={"b": "09", "c": "10"})
    assert rows(frame) == [("9", "10", f"{folder}small/b=9/c=10/", "stored")]


def test_given_location(spark, store, held, folder):
    assert store("select 7 as a", NEW, location=f"{folder}other") == "stored"
    assert (7, 9, 10) in held()
    assert has_objects(spark, f"{folder}other") and not has_objects(spark, f"{folder}small/b=9")


def test_overwrite_moves_the_partition_to_a_new_location(store, held, folder):
    store("select 7 as a", SPEC, location=f"{folder}other")
    assert held() == [AMERICA, (7, 3, 6)]
    store("select 8 as a", SPEC)
    assert held() == [AMERICA, (8, 3, 6)]


def test_odd_key_values(spark, db, folder):
    ctas(
        spark,
        "select 1 as a, 'x' as k, date '2020-01-01' as d",
        database=db,
        table="t",
        location=f"{folder}t",
        table_mode="empty",
        partitioned_by=["k", "d"],
    )
    values = ["2020-01-01 00:00/z", "it's", "back\\slash", "100%+1", "a=b", "ünï", "#[x]{y}^", 'q"q', "x?*:", "tab\tx"]
    for i, value in enumerate(values):
        spec = {"k": value, "d": "2020-1-5"}
        done = apas(spark, f"select {i} as a", database=db, table="t", partition_kv=spec).first()
        assert done.action == "stored" and done.d == "2020-01-05"
    found = {r.k: r.a for r in spark.table(f"{db}.t").collect()}
    assert found == {value: i for i, value in enumerate(values)}
    spark.sql(f"CREATE TABLE {db}.u LIKE {db}.t LOCATION '{folder}t'")
    spark.sql(f"ALTER TABLE {db}.u RECOVER PARTITIONS")
    assert rows(spark.table(f"{db}.u")) == rows(spark.table(f"{db}.t"))


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "textfile"])
def test_format_of_the_table_is_used(spark, db, folder, format):
    select = "select 'x\ny' as s, timestamp_ntz '2020-01-01 00:00:00.000001' as t, cast(null as int) as n"
    ctas(
        spark,
        f"select *, 1 as k from ({select})",
        database=db,
        table="t",
        location=f"{folder}t",
        format=format,
        compression="zlib" if format == "orc" else "gzip",
        field_delimiter=";",
        partitioned_by=["k"],
        table_mode="empty",
    )
    # Order and spelling of the columns need not be those of the table.
    apas(spark, f"select T, n as N, s from ({select})", database=db, table="t", partition_kv={"k": "1"})
    assert rows(spark.table(f"{db}.t")) == rows(spark.sql(f"select *, 1 as k from ({select})"))
    files = spark.table(f"{db}.t").inputFiles()
    ending = {"parquet": ".gz.parquet", "orc": ".zlib.orc", "json": ".json", "textfile": ".csv"}[format]
    assert all(name.endswith(ending) for name in files)
    if format == "textfile":
        assert ";" in spark.read.text(files[0], wholetext=True).first()[0]


def test_csv_table_made_by_hand(spark, db, folder):
    spark.sql(f"CREATE TABLE {db}.t (s STRING, t TIMESTAMP_NTZ, k INT) USING csv PARTITIONED BY (k) LOCATION '{folder}t'")
    select = "select ' x ' as s, timestamp_ntz '2020-01-01 00:00:00.000001' as t"
    apas(spark, select, database=db, table="t", partition_kv={"k": "1"})
    assert rows(spark.table(f"{db}.t")) == rows(spark.sql(f"select *, 1 as k from ({select})"))


def test_codec_of_the_table_properties(spark, db, folder):
    spark.sql(
        f"CREATE TABLE {db}.t (a INT, k INT) USING parquet PARTITIONED BY (k) LOCATION '{folder}t' "
        "TBLPROPERTIES ('parquet.compression' = 'gzip')"
    )
    apas(spark, "select 1 as a", database=db, table="t", partition_kv={"k": "1"})
    assert spark.table(f"{db}.t").inputFiles()[0].endswith(".gz.parquet")
    apas(spark, "select 1 as a", database=db, table="t", partition_kv={"k": "2"}, compression="zstd")
    assert any(name.endswith(".zstd.parquet") for name in spark.table(f"{db}.t").inputFiles())


def test_other_format_is_refused(store, held):
    with pytest.raises(ConfigError, match="could not read 'orc'"):
        store("select 7 as a", SPEC, format="orc")
    assert store("select 7 as a", SPEC, format="parquet") == "stored"


def test_bucketed_files(spark, db, small, store, held):
    assert store("select cast(id as int) as a from range(100)", NEW, bucketed_by=["a"], bucket_count=4) == "stored"
    assert len(held()) == 102
    files = [f for f in spark.table(f"{db}.{small}").where("b = 9").inputFiles()]
    assert len(files) == 4


def test_rows_without_the_shuffle(store, held):
    assert store("select cast(id as int) as a from range(100)", NEW, rebalance=False) == "stored"
    assert len(held()) == 102


def test_template(store, held, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("select ${value} as a;\n")
    assert store(path, NEW, params={"value": 42}) == "stored"
    assert (42, 9, 10) in held()


# --- schema ---


@pytest.mark.parametrize(
    "select, message",
    [
        ("select 1L as a", "a: int in .* but not in the SELECT; a: bigint"),
        ("select 1 as a, 2 as extra", "extra: int"),
        ("select 1 as z", "a: int in .*; z: int"),
        ("select 1 as a, 2 as b", "b: int"),
    ],
)
def test_schema_difference_changes_nothing(store, held, folder, select, message):
    with pytest.raises(SchemaMismatch, match=message):
        store(select, SPEC)
    assert held() == [AMERICA, EUROPE] and tidy(folder)


def test_difference_ignored_on_wish(store, held):
    assert store("select 7 as a, 8 as extra", NEW, ignore_schema_diff=True) == "stored"
    assert (7, 9, 10) in held()


def test_ignored_type_difference_shows_when_read(store, held):
    assert store("select 'x' as a", NEW, ignore_schema_diff=True) == "stored"
    with pytest.raises(Exception, match="PARQUET_COLUMN_DATA_TYPE_MISMATCH|FAILED_READ_FILE"):
        held()


def test_missing_column_of_a_text_table_is_null(spark, db, folder):
    select = "select 1 as x, 'y' as y, 3 as z, 1 as k"
    ctas(
        spark, select, database=db, table="t", location=f"{folder}t", format="textfile", partitioned_by=["k"]
    )
    apas(spark, "select 9 as z, 7 as x", database=db, table="t", partition_kv={"k": "2"}, ignore_schema_diff=True)
    assert rows(spark.table(f"{db}.t").where("k = 2")) == [(7, None, 9, 2)]


# --- save modes ---


def test_overwrite(store, held, folder):
    assert store("select 7 as a", SPEC) == "stored"
    assert held() == [AMERICA, (7, 3, 6)] and tidy(folder)


def test_overwrite_of_its_own_source(store, held, folder, db):
    for expected in (6, 7, 8):
        store("select a + 1 as a from small where b = 3", SPEC)
        assert held() == [AMERICA, (expected, 3, 6)]
    assert tidy(folder)


def test_overwrite_of_files_without_a_partition(spark, store, held, folder):
    spark.sql("select 100 as a").write.parquet(f"{folder}small/b=9/c=10")
    assert store("select 7 as a", NEW) == "stored"
    assert held() == [AMERICA, EUROPE, (7, 9, 10)]


def test_failing_select_keeps_the_old_rows(store, held, folder):
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        store("select cast(1 / (id - id) as int) as a from range(3)", SPEC)
    assert held() == [AMERICA, EUROPE] and tidy(folder)


def test_timeout_keeps_the_old_rows(store, held, folder):
    with pytest.raises(QueryTimeout):
        store(
            "select cast(sum(hash(id) % 7) as int) as a from range(100000000000)", SPEC, timeout=timedelta(seconds=1)
        )
    assert held() == [AMERICA, EUROPE] and tidy(folder)


@pytest.mark.parametrize("state", ["partition", "files"])
def test_skip_and_error_if_exists(spark, store, held, folder, state):
    spec = SPEC if state == "partition" else NEW
    if state == "files":
        spark.sql("select 100 as a").write.parquet(f"{folder}small/b=9/c=10")
    assert store("select 7 as a", spec, save_mode="skip_if_exists") == "kept"
    with pytest.raises(AlreadyExists):
        store("select 7 as a", spec, save_mode="error_if_exists")
    assert held() == [AMERICA, EUROPE]


@pytest.mark.parametrize("save_mode", ["skip_if_exists", "error_if_exists", "overwrite"])
def test_new_partition(store, held, save_mode):
    assert store("select 7 as a", NEW, save_mode=save_mode) == "stored"
    assert held() == [AMERICA, EUROPE, (7, 9, 10)]


# --- no rows ---


@pytest.mark.parametrize("spec", [SPEC, NEW])
def test_no_rows_no_partition(spark, db, small, store, held, folder, spec):
    assert store("select a from small where a > 100", spec) == "empty"
    assert held() == ([AMERICA] if spec == SPEC else [AMERICA, EUROPE])
    place = "/".join(f"{k}={v}" for k, v in spec.items())
    assert not has_objects(spark, f"{folder}small/{place}") and tidy(folder)
    assert store("select 7 as a", spec, save_mode="error_if_exists") == "stored"


@pytest.mark.parametrize("place", ["small", "small/", ""])
def test_the_table_itself_is_no_partition(store, held, folder, place):
    with pytest.raises(ConfigError, match="holds all of"):
        store("select 7 as a", NEW, location=f"{folder}{place}")
    assert held() == [AMERICA, EUROPE]
