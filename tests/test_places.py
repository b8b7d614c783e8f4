"""The index of places that no key tells: what it finds, and how little it asks the catalog."""

import pytest
from conftest import AMERICA, rows

from partloom import add_partition, apas, apas_many, ctas, drop_partition
from partloom.errors import ConfigError
from partloom.sources import places
from partloom.sources.catalog import TableName, add_to_catalog, default_location, describe_table

SPEC = {"b": "3", "c": "6"}


@pytest.fixture
def listings(monkeypatch):
    """How often the catalog was listed as a whole."""
    kept, seen = places.every_location, []
    monkeypatch.setattr(places, "every_location", lambda spark, info: seen.append(1) or kept(spark, info))
    return seen


def store(spark, db, value=8, **options):
    return apas(spark, f"select {value} as a", **{"database": db, "table": "small", "partition_kv": SPEC, **options})


def test_the_catalog_is_listed_once(spark, small, db, folder, listings):
    for value in range(3):
        store(spark, db, value)
        store(spark, db, value, location=f"{folder}away")
        store(spark, db, value, relocate=True)
    drop_partition(spark, database=db, table=small, partition_kv=SPEC, with_location=True)
    apas_many(spark, "select 4 as a, 1 as b, 7 as c", database=db, table=small)
    assert len(listings) == 1 and rows(spark.table(f"{db}.small")) == [(4, 1, 7)]


def test_a_table_made_anew_is_listed_anew(spark, small, db, folder, listings):
    store(spark, db)
    again = "select cast(1 as int) as a, 3 as b, 6 as c"
    ctas(spark, again, database=db, table=small, location=f"{folder}small", partitioned_by=["b", "c"])
    store(spark, db)
    assert len(listings) == 2


@pytest.mark.parametrize("place", ["away", "away/deep", "small/b=3/c=6/deep", "small/b=3/c=6", "small/b=3"])
def test_places_of_others_are_refused(spark, small, db, folder, place):
    """Whether noted as they were registered, or found by the first listing."""
    target = {"away": "away", "away/deep": "away"}.get(place)
    for value, known in ((1, True), (2, False)):
        (spark.createDataFrame([(5,)], "a int").write.mode("overwrite").parquet(f"{folder}{place}"))
        add_partition(spark, database=db, table=small, partition_kv={"b": "9", "c": "9"}, location=f"{folder}{place}")
        if not known:
            places.forget(spark, describe_table(spark, TableName(db, small)))
        with pytest.raises(ConfigError, match="shares its directory|holds all"):
            store(spark, db, value, **({"location": f"{folder}{target}"} if target else {}))
        drop_partition(spark, database=db, table=small, partition_kv={"b": "9", "c": "9"})
    # The note is stale by now: it costs a look and no more.
    store(spark, db, 3, **({"location": f"{folder}{target}"} if target else {}))
    assert (3, 3, 6) in rows(spark.table(f"{db}.small"))


def test_places_above_and_inside_the_table(spark, small, db, folder):
    for place in (f"{folder}small/b=1", f"{folder}small/b=1/c=7", f"{folder}small/b=1/c=7/x"):
        with pytest.raises(ConfigError, match="shares its directory"):
            store(spark, db, location=place)
    with pytest.raises(ConfigError, match="holds all"):
        store(spark, db, location=folder)
    assert AMERICA in rows(spark.table(f"{db}.small"))


def test_own_places(spark, small, db, folder):
    info = describe_table(spark, TableName(db, small))
    at = lambda place: places.at_home(spark, info, SPEC, place)
    run = "_run=" + "0" * 32
    assert at(default_location(info, SPEC)) and at(f"{folder}small/b=3/{run}/") and at(f"{folder}small/{run}/b=3/c=6")
    assert not at(f"{folder}small/b=3/c=6/{run}/") and not at(f"{folder}small/b=3/") and not at(f"{folder}small/{run}/")


def test_an_overwrite_of_many_partitions(spark, db, folder, listings):
    """The work of an overwrite does not follow the number of partitions."""
    ctas(spark, "select 1 as a, 0 as k", database=db, table="many", location=f"{folder}many", partitioned_by=["k"])
    info = describe_table(spark, TableName(db, "many"))
    specs = [{"k": str(i)} for i in range(1, 3000)]
    add_to_catalog(spark, info, specs, [default_location(info, spec) for spec in specs])
    calls = []
    for _ in range(2):
        kept = type(spark).sql
        count = []
        type(spark).sql = lambda self, *given, **options: count.append(1) or kept(self, *given, **options)  # noqa: B023
        try:
            apas(spark, "select 2 as a", database=db, table="many", partition_kv={"k": "7"})
        finally:
            type(spark).sql = kept
        calls.append(len(count))
    assert calls[0] <= 12 and calls[1] <= 12 and len(listings) == 1
