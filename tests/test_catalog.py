"""Every operator with the catalog named outright, and with names that need quoting."""

import pytest
from conftest import rows

from partloom import (
    add_partition,
    apas,
    ctas,
    diff_schema,
    drop_partition,
    drop_table,
    drop_table_multi,
    for_each_database,
    list_databases,
    partition_exists,
    query,
    table_exists,
)
from partloom.errors import ConfigError

CATALOG = {"catalog": "spark_catalog"}


def test_only_the_session_catalog_is_rewritten(spark, db):
    with pytest.raises(ConfigError, match="other"):
        ctas(spark, "select 1 as a", database=db, table="t", catalog="other")


@pytest.mark.parametrize("database, table, key", [("plain", "t", "b"), ("Odd_1", "T1", "key b")])
def test_all_operators(spark, db, folder, database, table, key):
    database = f"{db}_{database}"
    spark.sql(f"CREATE DATABASE `{database}` LOCATION '{folder}x'")
    on = {"database": database, "table": table, **CATALOG}
    select = f"select 1 as a, 2 as `{key}` union all select 4, 5"
    try:
        make = lambda **options: ctas(spark, select, partitioned_by=[key], **on, **options)
        place = f"{folder}t"
        assert rows(make(location=place).frame) == [(1, 2), (4, 5)]
        assert rows(make(location=place).frame) == [(1, 2), (4, 5)]
        assert rows(make(location=f"{folder}u").frame) == [(1, 2), (4, 5)]
        assert rows(make(location=f"{folder}v", table_mode="data_only", save_mode="none").frame) == [(1, 2), (4, 5)]

        run = query(spark, f"select count(*) as n from `{table}`", database=database, output=folder, **CATALOG)
        assert run.frame.first().n == 2
        assert apas(spark, "select 7 as a", partition_kv={key: "9"}, **on).first().action == "stored"
        assert apas(spark, f"select a + 1 as a from `{table}` where `{key}` = 9", partition_kv={key: "9"}, **on)
        assert rows(spark.table(f"`{database}`.`{table}`")) == [(1, 2), (4, 5), (8, 9)]

        specs = [{key: "9"}, {key: "5"}]
        assert drop_partition(spark, partition_kv=specs, **on).where("action = 'dropped'").count() == 2
        assert rows(partition_exists(spark, partition_kv=specs, with_location=True, **on)) == [
            ("5", False, False),
            ("9", False, False),
        ]
        assert add_partition(spark, partition_kv=specs, **on).where("action = 'added'").count() == 2
        assert rows(partition_exists(spark, partition_kv=specs, with_location=True, **on)) == [
            ("5", True, True),
            ("9", True, True),
        ]
        same = diff_schema(spark, database=database, original=table, comparison=table, error_if_diff_found=False, **CATALOG)
        assert same.where("side = 'both'").count() == 1

        assert table_exists(spark, with_location=True, **on).first()["table_exists"]
        assert table_exists(spark, database=database, table=[table, "nowhere"], **CATALOG).where("table_exists").count() == 1
        found = for_each_database(
            spark, lambda d: spark.table(f"`{d.name}`.`{table}`"), regexp=f"{db}_.*", **CATALOG
        )
        assert found.count() == 3 and [d.name for d in list_databases(spark, regexp=f"{db}_.*")] == [database.lower()]

        make(location=f"{folder}w", save_mode="overwrite", table_mode="empty")
        assert drop_table(spark, with_location=True, **on).first().action == "dropped"
        make(location=f"{folder}z")
        done = drop_table_multi(spark, database=database, regexp="t.*", with_location=True, **CATALOG)
        assert rows(done, "table", "action") == [(table.lower(), "dropped")]
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
