"""Buckets that the planner knows, bytes that were read, limits over the driver's own phases, listings by the cluster."""

import importlib
import os
import time
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import rows

from partloom import Protect, apas, apas_many, ctas, drop_table_multi, query
from partloom.errors import ConfigError, QueryFailed
from partloom.plans.limits import limited
from partloom.sources import storage

query_operator = importlib.import_module("partloom.operators.query")


def bucketed(spark, db, folder, **options):
    ctas(spark, "select id as a, id % 7 as b, 'x' as k from range(0)", database=db, table="t", location=f"{folder}t",
         table_mode="empty", partitioned_by=["k"], bucketed_by=["b"], bucket_count=4, **options)


def test_partitions_take_the_buckets_of_their_table(spark, db, folder):
    bucketed(spark, db, folder)
    apas(spark, "select id as a, id % 7 as b from range(100)", database=db, table="t", partition_kv={"k": "x"})
    apas(spark, "select id as a, id % 7 as b from range(50)", database=db, table="t", partition_kv={"k": "y"}, rebalance=False, bucketed_by=["B"], bucket_count=4)
    apas_many(spark, "select id as a, id % 7 as b, 'z' as k from range(30)", database=db, table="t")
    files = [p.name for p in Path(folder.removeprefix("file:") + "t").rglob("part-*.parquet")]
    assert files and all(name.split("_")[-1][:5].isdigit() for name in files)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        grouped = spark.table(f"{db}.t").groupBy("b").count()
        joined = spark.table(f"{db}.t").alias("l").join(spark.table(f"{db}.t").alias("r"), "b")
        for frame in (grouped, joined):
            assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
        assert rows(grouped) == sorted((b, sum(1 for n in (100, 50, 30) for i in range(n) if i % 7 == b)) for b in range(7))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_other_buckets_are_refused(spark, db, folder):
    bucketed(spark, db, folder)
    for other in ({"bucketed_by": ["a"], "bucket_count": 4}, {"bucketed_by": ["b"], "bucket_count": 8}):
        with pytest.raises(ConfigError, match="buckets"):
            apas(spark, "select 1L as a, 1L as b", database=db, table="t", partition_kv={"k": "x"}, **other)


def test_sorted_buckets(spark, db, folder):
    spark.sql(f"CREATE TABLE {db}.t (a BIGINT, b BIGINT, k STRING) USING parquet PARTITIONED BY (k) CLUSTERED BY (b) SORTED BY (a) INTO 2 BUCKETS LOCATION '{folder}t'")
    apas(spark, "select 100 - id as a, id % 7 as b from range(100)", database=db, table="t", partition_kv={"k": "x"})
    assert spark.table(f"{db}.t").count() == 100
    for path in Path(folder.removeprefix("file:") + "t").rglob("part-*.parquet"):
        values = [r.a for r in spark.read.parquet(f"file:{path}").collect()]
        assert values == sorted(values)


def test_bytes_of_a_join_that_prunes(spark, db, folder):
    ctas(spark, "select id as a, id % 5 as k from range(5000)", database=db, table="t", location=f"{folder}t", partitioned_by=["k"])
    ctas(spark, "select id as k, concat('n', id) as name from range(5)", database=db, table="n", location=f"{folder}n")
    size = lambda place: sum(p.stat().st_size for p in Path(folder.removeprefix("file:") + place).rglob("part-*"))
    run = query(spark, "select a from t join n on t.k = n.k where name = 'n3' order by a", database=db, output=folder)
    assert run.scan_bytes == size("t/k=3") + size("n") and run.frame.count() == 1000
    whole = query(spark, "select sum(a) from t", database=db, output=folder)
    assert whole.scan_bytes == size("t")
    twice = query(spark, "select a from t where k = 1 union all select a from t where k = 2", database=db, output=folder)
    assert twice.scan_bytes == size("t/k=1") + size("t/k=2")
    assert query(spark, "select 1 as a", output=folder).scan_bytes == 0


def test_odd_columns_are_stored(spark, folder):
    run = query(spark, "select named_struct('x y', 1, 'z`', array(2)) as `a b`, map('k', 1) as `c,d`, 1 as `e``f`, 2 as `E``F`", output=folder)
    row = run.frame.first()
    assert row[0]["x y"] == 1 and row[1] == {"k": 1} and tuple(row)[2:] == (1, 2)


def test_a_phase_without_jobs_ends_with_its_limit(spark, folder, monkeypatch):
    monkeypatch.setattr(query_operator, "session_in", lambda *_: time.sleep(30))
    started = time.time()
    with pytest.raises(QueryFailed) as told:
        query(spark, "select 1", output=folder, timeout=timedelta(seconds=1))
    assert time.time() - started < 4 and told.value.run.state == "CANCELLED"


def test_what_a_limited_call_returns_or_raises(spark):
    assert limited(spark, timedelta(seconds=60), lambda: spark.range(3).count()) == 3
    assert limited(spark, None, lambda: 5) == 5
    with pytest.raises(KeyError):
        limited(spark, timedelta(seconds=60), lambda: {}["x"])


def test_young_files_are_found_by_the_cluster(spark, db, folder, monkeypatch):
    spark.range(0, 300, 1, 300).selectExpr("id", "id % 40 as k").write.partitionBy("k").parquet(f"{folder}t")
    newest = max(p.stat().st_mtime for p in Path(folder.removeprefix("file:") + "t").rglob("part-*"))
    calls, opened = [], storage._open
    monkeypatch.setattr(storage, "_open", lambda *given: calls.append(1) or opened(*given))
    marker = Path(folder.removeprefix("file:") + "t/_SUCCESS")
    marker.unlink()
    assert storage.newest_file(spark, f"{folder}t", int(newest * 1000) - 2)
    assert not storage.newest_file(spark, f"{folder}t", int(newest * 1000) + 2)
    marker.touch()
    assert storage.newest_file(spark, f"{folder}t", int(newest * 1000) - 2)
    assert not storage.newest_file(spark, f"{folder}nowhere", 0) and len(calls) == 4


def test_protected_by_a_young_file_deep_inside(spark, db, folder):
    ctas(spark, "select 1 as a, 2 as k", database=db, table="t", location=f"{folder}t", partitioned_by=["k"])
    place = Path(folder.removeprefix("file:") + "t")
    old = datetime(2020, 1, 1, tzinfo=timezone.utc).timestamp()
    for path in place.rglob("*"):
        os.utime(path, (old, old))
    time.sleep(2.2)
    told = drop_table_multi(spark, database=db, regexp="t", protect=Protect(updated_within=timedelta(seconds=2)), limit=0)
    assert told.count() == 0
    apas(spark, "select 3 as a", database=db, table="t", partition_kv={"k": "2"})
    kept = drop_table_multi(spark, database=db, regexp="t", protect=Protect(updated_within=timedelta(seconds=60)))
    assert kept.first().action == "protected"


def test_tables_that_were_read_are_kept(spark, db, folder):
    for name in ("a", "b", "c", "d", "e"):
        ctas(spark, f"select 1 as {name}, 1 as k", database=db, table=f"t_{name}", location=f"{folder}t_{name}", partitioned_by=["k"])
    spark.sql(f"CREATE VIEW {db}.over_c AS SELECT * FROM {db}.t_c")
    query(spark, "select * from t_a where a in (select b from t_b)", database=db, output=folder)
    ctas(spark, f"select * from {db}.over_c", database=db, table="other", location=f"{folder}other")
    apas(spark, f"select d as a from {db}.t_d", database=db, table="t_a", partition_kv={"k": "7"})
    told = drop_table_multi(spark, database=db, regexp="t_.", protect=Protect(accessed_within=timedelta(minutes=5)))
    assert rows(told, "table", "action") == [("t_a", "protected"), ("t_b", "protected"), ("t_c", "protected"), ("t_d", "protected"), ("t_e", "dropped")]
    old = datetime(2020, 1, 1, tzinfo=timezone.utc).timestamp()
    for path in Path(folder.removeprefix("file:")).glob("_access.*"):
        os.utime(path, (old, old))
    query(spark, "select * from t_a", database=db, output=folder)
    told = drop_table_multi(spark, database=db, regexp="t_.", protect=Protect(accessed_within=timedelta(minutes=5)))
    assert rows(told, "table", "action")[0] == ("t_a", "protected") and told.where("action = 'dropped'").count() == 3


def test_a_note_that_cannot_be_written_stops_nothing(spark, db, folder, monkeypatch):
    from partloom.errors import StorageError
    from partloom.sources import access

    def fail(*_):
        raise StorageError("read-only")

    ctas(spark, "select 1 as a", database=db, table="t", location=f"{folder}t")
    monkeypatch.setattr(access, "create_new", fail)
    assert query(spark, "select * from t", database=db, output=folder).frame.count() == 1
