"""Text files that many tasks read: how lines end follows what the values hold."""

import pytest
from conftest import rows

from partloom import apas, ctas
from partloom.errors import ConfigError
from partloom.sources.catalog import TableName, describe_table

PLAIN = ["a", "", None, "tab\t, bar|", "car\rriage", 'q"u"ote', " lead and trail ", "\\", "\\n", "\\N not alone", "é日本\U0001f600", "\x01"]
LINES = [*PLAIN, "a\nb", "\n", "c\r\nd", '"\n"']
EVERY = [*LINES, "x\x1ey", "\x1e", "\x1e\n"]


def options(spark, db, name="t"):
    return describe_table(spark, TableName(db, name)).storage_properties


def made(spark, db, values, **given):
    frame = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, a string, b string").repartition(3)
    frame.createOrReplaceTempView("given_lines")
    return ctas(spark, "select * from given_lines", database=db, table="t", format="textfile", **given)


@pytest.mark.parametrize("values,end,whole", [(PLAIN, "\n", False), (LINES, "\x1e", False), (EVERY, "\n", True)])
@pytest.mark.parametrize("mode", ["default", "data_only"])
def test_values_come_back(spark, db, values, end, whole, mode):
    result = made(spark, db, values, table_mode=mode)
    assert sorted(rows(result.frame), key=lambda r: r[0]) == [(i, v, v) for i, v in enumerate(values)]
    if mode == "default":
        told = options(spark, db)
        assert told["lineSep"] == end and ("multiLine" in told) == whole


def test_overwrites_and_partitions(spark, db, folder):
    for values in (LINES, PLAIN, EVERY):
        made(spark, db, values, location=f"{folder}t", partitioned_by=["b"] if values is PLAIN else [])
        assert sorted(r[1] or "" for r in rows(spark.table(f"{db}.t"), "i", "a")) == sorted(v or "" for v in values)


def test_a_partition_follows_its_table(spark, db, folder):
    select = "select 1 as i, 'x\\ny' as a, 'k' as k"
    ctas(spark, select, database=db, table="t", location=f"{folder}t", format="textfile", partitioned_by=["k"])
    assert options(spark, db)["lineSep"] == "\x1e"
    apas(spark, "select 2 as i, 'u\\nv\\r' as a", database=db, table="t", partition_kv={"k": "l"})
    assert rows(spark.table(f"{db}.t")) == [(1, "x\ny", "k"), (2, "u\nv\r", "l")]
    with pytest.raises(ConfigError, match="ends the lines"):
        apas(spark, "select 3 as i, concat('u', char(30)) as a", database=db, table="t", partition_kv={"k": "l"})
    assert rows(spark.table(f"{db}.t")) == [(1, "x\ny", "k"), (2, "u\nv\r", "l")]


def test_an_empty_table_takes_any_text(spark, db, folder):
    ctas(spark, "select '' as a, 'k' as k", database=db, table="t", location=f"{folder}t", format="textfile", table_mode="empty", partitioned_by=["k"])
    apas(spark, "select concat('u', char(30), '\\n') as a", database=db, table="t", partition_kv={"k": "l"})
    assert rows(spark.table(f"{db}.t")) == [("u\x1e\n", "l")]


def test_one_large_file_is_read_by_many_tasks(spark, db):
    select = "select id, concat(repeat('some words ', 20), '\\n', uuid()) as a from range(0, 40000, 1, 1)"
    made_table = ctas(spark, select, database=db, table="t", format="textfile", rebalance=False)
    assert len(made_table.frame.inputFiles()) == 1
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "1m")
    try:
        found = spark.table(f"{db}.t")
        assert found.rdd.getNumPartitions() >= 8 and found.count() == 40000
        assert found.where("length(a) <> 257").count() == 0 and found.selectExpr("sum(id)").first()[0] == 40000 * 39999 // 2
    finally:
        spark.conf.unset(key)
