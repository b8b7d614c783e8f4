import os
import time
from datetime import timedelta
from pathlib import Path

import pytest
from conftest import rows

from partloom import Protect, ctas, diff_schema, drop_table, drop_table_multi, table_exists
from partloom.errors import ConfigError, NotFound, SchemaMismatch
from partloom.sources.storage import has_objects


@pytest.fixture
def make(spark, db, folder):
    def call(*names):
        for name in names:
            ctas(spark, "select 1 as a", database=db, table=name, location=f"{folder}{name}")

    return call


@pytest.fixture
def names(spark, db):
    return lambda: [n for (n,) in rows(spark.sql(f"SHOW TABLES IN {db}").where("NOT isTemporary"), "tableName")]


# --- table_exists ---


def test_exists(spark, db, make, folder):
    make("x", "y")
    spark.sql(f"CREATE TABLE {db}.hollow (a INT) USING parquet LOCATION '{folder}hollow'")
    spark.sql(f"CREATE VIEW {db}.seen AS SELECT 1 AS a")
    wanted = ["x", "hollow", "nowhere", "seen", "Y"]
    found = table_exists(spark, database=db, table=wanted)
    assert [tuple(r) for r in found.select("table", "table_exists", "location_exists").collect()] == [
        ("x", True, None),
        ("hollow", True, None),
        ("nowhere", False, None),
        ("seen", True, None),
        ("Y", True, None),
    ]
    found = table_exists(spark, database=db, table=wanted, with_location=True)
    assert [r.location_exists for r in found.collect()] == [True, False, False, False, True]
    assert not table_exists(spark, database="nowhere", table="x").first().table_exists
    assert not table_exists(spark, database="nowhere", table=["x", "y"], with_location=True).first().location_exists


def test_exists_as_an_error(spark, db, make, folder):
    make("x")
    spark.sql(f"CREATE TABLE {db}.hollow (a INT) USING parquet LOCATION '{folder}hollow'")
    table_exists(spark, database=db, table=["x", "hollow"], error_if_not_exist=True)
    with pytest.raises(NotFound, match="nowhere"):
        table_exists(spark, database=db, table=["x", "nowhere"], error_if_not_exist=True)
    with pytest.raises(NotFound, match="hollow"):
        table_exists(spark, database=db, table="hollow", error_if_not_exist=True, with_location=True)


# --- drop_table ---


def test_drop(spark, db, make, names, folder):
    make("x", "y", "z")
    assert rows(drop_table(spark, database=db, table="x")) == [(db, "x", f"{folder}x/", "dropped")]
    assert has_objects(spark, f"{folder}x")
    done = drop_table(spark, database=db, table=["y", "nowhere"], with_location=True)
    assert [r.action for r in done.collect()] == ["dropped", "absent"]
    assert not has_objects(spark, f"{folder}y") and names() == ["z"]


def test_drop_absent(spark, db, make, names):
    make("x")
    assert drop_table(spark, database=db, table="nowhere").first().action == "absent"
    assert drop_table(spark, database="nowhere", table="x").first().action == "absent"
    with pytest.raises(NotFound):
        drop_table(spark, database=db, table=["x", "nowhere"], ignore_if_not_exist=False)
    assert names() == ["x"]


def test_drop_managed(spark, db, make, names):
    make("x")
    spark.sql(f"CREATE TABLE {db}.m AS SELECT 1 AS a")
    with pytest.raises(ConfigError, match="managed"):
        drop_table(spark, database=db, table=["x", "m"])
    assert names() == ["m", "x"]
    drop_table(spark, database=db, table="m", with_location=True)
    assert names() == ["x"]


def test_drop_view(spark, db, names):
    spark.sql(f"CREATE VIEW {db}.seen AS SELECT 1 AS a")
    assert drop_table(spark, database=db, table="seen", with_location=True).first().location is None
    assert names() == []


# --- drop_table_multi ---


def test_multi_matches_whole_names(spark, db, make, names):
    make("a1", "a2", "xa1", "a1x")
    done = drop_table_multi(spark, database=db, regexp="a1|a2")
    assert rows(done, "table", "action") == [("a1", "dropped"), ("a2", "dropped")]
    assert names() == ["a1x", "xa1"]


def test_multi_needs_its_regexp(spark, db):
    for regexp in ("", None):
        with pytest.raises(ConfigError):
            drop_table_multi(spark, database=db, regexp=regexp)
    with pytest.raises(NotFound):
        drop_table_multi(spark, database="nowhere", regexp="x")


def test_multi_limit_counts_before_protection(spark, db, make, names, folder):
    make("t1", "t2", "t3")
    age(folder, "t2", hours=5)
    protect = Protect(updated_within=timedelta(hours=1))
    # Creation counts as an update, so all three are young.
    assert drop_table_multi(spark, database=db, regexp="t.", protect=protect).count() == 3
    assert names() == ["t1", "t2", "t3"]
    time.sleep(1.1)
    protect = Protect(created_within=timedelta(milliseconds=1))
    done = drop_table_multi(spark, database=db, regexp="t.", limit=2, protect=protect)
    assert rows(done, "table", "action") == [("t1", "dropped"), ("t2", "dropped")]
    assert names() == ["t3"]


def test_multi_protects_by_file_times(spark, db, make, names, folder):
    make("t1", "t2")
    time.sleep(4)
    age(folder, "t1", hours=5)
    young = Path(folder.removeprefix("file:"), "t2")
    for path in young.iterdir():
        os.utime(path)
    protect = Protect(updated_within=timedelta(seconds=3))
    done = drop_table_multi(spark, database=db, regexp="t.", protect=protect)
    assert rows(done, "table", "action") == [("t1", "dropped"), ("t2", "protected")]


def test_multi_unknown_access_time_does_not_protect(spark, db, make, names):
    make("t1")
    protect = Protect(accessed_within=timedelta(hours=1))
    assert drop_table_multi(spark, database=db, regexp="t.", protect=protect).first().action == "dropped"


def test_multi_with_location(spark, db, make, folder):
    make("t1", "t2")
    drop_table_multi(spark, database=db, regexp="t1", with_location=True)
    drop_table_multi(spark, database=db, regexp="t2")
    assert not has_objects(spark, f"{folder}t1") and has_objects(spark, f"{folder}t2")


def age(folder, table, hours):
    for path in Path(folder.removeprefix("file:"), table).iterdir():
        os.utime(path, (time.time() - hours * 3600,) * 2)


# --- diff_schema ---


def test_diff(spark, db):
    spark.sql(f"CREATE TABLE {db}.o (a INT COMMENT 'x', B STRING, c MAP<STRING, INT>, k INT) USING parquet PARTITIONED BY (k)")
    spark.sql(f"CREATE TABLE {db}.n (b STRING COMMENT 'y', d DECIMAL(5, 2), A BIGINT) USING parquet")
    found = diff_schema(spark, database=db, original="o", comparison="n", error_if_diff_found=False)
    assert found.columns == ["column", "original_type", "comparison_type", "side"]
    assert rows(found) == [
        ("a", "int", None, "left_only"),
        ("a", None, "bigint", "right_only"),
        ("b", "string", "string", "both"),
        ("c", "map<string,int>", None, "left_only"),
        ("d", None, "decimal(5,2)", "right_only"),
    ]
    with pytest.raises(SchemaMismatch, match="a: int, c: map"):
        diff_schema(spark, database=db, original="o", comparison="n")


def test_no_diff(spark, db):
    spark.sql(f"CREATE TABLE {db}.o (a INT, b STRING) USING parquet")
    spark.sql(f"CREATE TABLE {db}.n (b STRING, a INT) USING json")
    found = diff_schema(spark, database=db, original="o", comparison="n")
    assert {r.side for r in found.collect()} == {"both"}
