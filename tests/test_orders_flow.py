"""A day in the life of an orders table: load, correct, publish, retire."""

from datetime import timedelta

from conftest import SF, rows

from partloom import (
    Protect,
    add_partition,
    apas,
    ctas,
    drop_partition,
    drop_table_multi,
    for_each_database,
    partition_exists,
    preview,
    query,
    table_exists,
)
from partloom.sources.storage import has_objects

PARAMS = {"sf": SF, "filter": {"above": 100000}}
LARGE = "SELECT o_orderkey, o_totalprice, o_orderstatus AS status FROM parquet.`${sf}/orders.parquet` WHERE o_totalprice > ${filter.above}"


def test_orders_by_status(spark, db, folder, tmp_path):
    source = spark.read.parquet(f"{SF}/orders.parquet").where("o_totalprice > 100000")
    expected = {r.o_orderstatus: r["count"] for r in source.groupBy("o_orderstatus").count().collect()}

    def counted():
        return dict(rows(spark.table(f"{db}.large").groupBy("status").count()))

    # The statement lives in a file; a first look at what it gives.
    script = tmp_path / "large.sql"
    script.write_text(LARGE + ";\n")
    run = query(spark, script, params=PARAMS, output=f"{folder}runs")
    assert run.state == "SUCCEEDED" and run.frame.count() == source.count()
    assert [c.name for c in preview(spark, run.id, 3).columns] == ["o_orderkey", "o_totalprice", "status"]

    # Load everything, by status.
    ctas(spark, script, params=PARAMS, database=db, table="large", location=f"{folder}large", partitioned_by=["status"])
    assert counted() == expected

    # Finished orders are taken out of sight while they are checked, then come back from their files.
    finished = {"status": "F"}
    drop_partition(spark, database=db, table="large", partition_kv=finished)
    assert counted() == {k: n for k, n in expected.items() if k != "F"}
    add_partition(spark, database=db, table="large", partition_kv=finished)
    assert counted() == expected

    # A correction of one status, once in place and once beside it; another status is new.
    for relocate in (False, True):
        corrected = f"SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM {db}.large WHERE status = 'F'"
        apas(spark, corrected, database=db, table="large", partition_kv=finished, relocate=relocate)
    total = source.where("o_orderstatus = 'F'").selectExpr("sum(o_totalprice) AS s").first().s
    assert abs(spark.sql(f"SELECT sum(o_totalprice) AS s FROM {db}.large WHERE status = 'F'").first().s - 4 * total) < 1
    apas(spark, "SELECT 1L AS o_orderkey, 2.0D AS o_totalprice", database=db, table="large", partition_kv={"status": "new"})
    told = partition_exists(
        spark, database=db, table="large", partition_kv=[finished, {"status": "new"}, {"status": "gone"}], with_location=True
    )
    assert rows(told, "status", "partition_exists", "location_exists") == [("F", True, True), ("gone", False, False), ("new", True, True)]

    # The new status was a mistake: its files go, too.
    drop_partition(spark, database=db, table="large", partition_kv={"status": "new"}, with_location=True)
    assert counted() == expected and not has_objects(spark, f"{folder}large/status=new")

    # Reports per status live for a while and are then retired by name.
    for status in sorted(expected):
        report = f"SELECT count(*) AS n FROM {db}.large WHERE status = '{status}'"
        ctas(spark, report, database=db, table=f"report_{status.lower()}", location=f"{folder}reports/{status}")
    young = Protect(updated_within=timedelta(hours=1))
    kept = drop_table_multi(spark, database=db, regexp="report_.", protect=young, with_location=True)
    assert {r.action for r in kept.collect()} == {"protected"}
    gone = drop_table_multi(spark, database=db, regexp="report_.", limit=1, with_location=True).first()
    found = table_exists(spark, database=db, table=[gone.table, "large"], with_location=True)
    assert rows(found, "table", "table_exists", "location_exists") == [("large", True, True), (gone.table, False, False)]

    # The same number for every database that has the table.
    counts = for_each_database(spark, lambda d: spark.sql(f"SELECT count(*) AS n FROM {d.name}.large"), regexp=db)
    assert rows(counts, "database", "n") == [(db, sum(expected.values()))]
