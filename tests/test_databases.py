import pytest
from conftest import rows

from partloom import ctas, database_inventory, for_each_database, list_databases


@pytest.fixture
def pair(spark, db, folder):
    names = [f"{db}_x", f"{db}_y"]
    for i, name in enumerate(names):
        spark.sql(
            f"CREATE DATABASE {name} COMMENT 'number {i}' LOCATION '{folder}{name}' "
            f"WITH DBPROPERTIES ('n' = '{i}', 'list' = 'a, b')"
        )
        ctas(spark, f"select id from range({i + 3})", database=name, table="t")
    return names


def test_inventory(spark, db, pair):
    assert [d.name for d in list_databases(spark, regexp=f"{db}_.")] == pair
    assert {"default", db, *pair} <= {d.name for d in list_databases(spark)}
    found = database_inventory(spark, regexp=f"{db}_.").collect()
    assert [r.description for r in found] == ["number 0", "number 1"]
    assert [r.parameters for r in found] == [{"n": "0", "list": "a, b"}, {"n": "1", "list": "a, b"}]
    assert all(r.created_at is None and r.location.endswith(r.name) for r in found)
    plain = list_databases(spark, regexp=db)[0]
    assert plain.description is None and plain.parameters == {}


def test_each(spark, db, pair):
    found = for_each_database(
        spark,
        lambda d: spark.table(f"{d.name}.t").selectExpr(f"'{d.parameters['n']}' AS n", "count(*) OVER () AS rows").distinct(),
        regexp=f"{db}_.",
    )
    assert rows(found, "database", "n", "rows") == [(pair[0], "0", 3), (pair[1], "1", 4)]


def test_each_for_its_effect(spark, db, pair):
    found = for_each_database(spark, lambda d: spark.sql(f"DROP TABLE {d.name}.t") and None, regexp=f"{db}_.")
    assert found.columns == ["database"] and found.isEmpty()
    assert not any(spark.catalog.tableExists(f"{name}.t") for name in pair)


def test_each_of_none(spark):
    assert for_each_database(spark, lambda d: spark.range(1), regexp="no such name").isEmpty()
