"""Add, drop and check partitions, one or a set per call."""

from __future__ import annotations

import logging
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from partloom.errors import AlreadyExists, ConfigError, NotFound
from partloom.operators.ctas import choose
from partloom.sources.catalog import (
    Spec,
    TableInfo,
    TableName,
    add_to_catalog,
    as_specs,
    default_location,
    describe_table,
    drop_from_catalog,
    move_in_catalog,
    order_specs,
    partition_locations,
    partitioned_table,
    present,
    table_exists,
)
from partloom.sources.places import note, others_at
from partloom.sources.storage import delete_tree, for_each, has_objects, holds, normalise

log = logging.getLogger(__name__)

SAVE_MODES = ("overwrite", "skip_if_exists", "error_if_exists")


def add_partition(
    spark: SparkSession,
    *,
    database: str,
    table: str,
    partition_kv: Spec | Sequence[Spec],
    location: str | Sequence[str | None] | None = None,
    save_mode: str = "overwrite",
    follow_location: bool = True,
    catalog: str | None = None,
) -> DataFrame:
    """Register directories as partitions: keys, ``location`` and the ``action`` taken.

    With ``follow_location`` the catalog follows the files: where there are none,
    a new partition is not added and an old one is dropped (``overwrite``), kept
    (``skip_if_exists``) or an error. All errors are raised before any change.
    """
    choose("save_mode", save_mode, SAVE_MODES)
    info = partitioned_table(spark, TableName(database, table, catalog))
    specs = order_specs(spark, info, as_specs(partition_kv))
    places = _locations(info, specs, location)
    held = present(spark, info, specs)
    filled = for_each(spark, lambda place: has_objects(spark, place), places)

    if save_mode == "error_if_exists" and any(held):
        # The same answer whether or not the location holds objects.
        raise AlreadyExists(f"{info.name} already has the partitions {_picked(specs, held)}")
    actions = [
        _action(save_mode, is_held, is_filled or not follow_location) for is_held, is_filled in zip(held, filled)
    ]
    for spec, place, is_filled, action in zip(specs, places, filled, actions):
        if not is_filled:
            log.warning("%s %s: no objects at %s, %s", info.name, spec, place, action)

    added = [action == "added" for action in actions]
    dropped = [action == "dropped" for action in actions]
    refuse_managed(info, any(dropped))
    moved = [action == "relocated" for action in actions]
    told = [a or m for a, m in zip(added, moved)]
    note(spark, info, _picked(specs, told), _picked(places, told))
    add_to_catalog(spark, info, _picked(specs, added), _picked(places, added))
    for_each(
        spark, lambda pair: move_in_catalog(spark, info, *pair), zip(_picked(specs, moved), _picked(places, moved))
    )
    drop_from_catalog(spark, info, _picked(specs, dropped))
    spark.catalog.refreshTable(info.name.sql)
    return outcome(spark, info.partition_columns, specs, places, actions)


def _action(save_mode: str, held: bool, wanted: bool) -> str:
    if not held:
        return "added" if wanted else "skipped"
    if save_mode == "skip_if_exists":
        return "kept"
    return "relocated" if wanted else "dropped"


def drop_partition(
    spark: SparkSession,
    *,
    database: str,
    table: str,
    partition_kv: Spec | Sequence[Spec],
    with_location: bool = False,
    ignore_if_not_exist: bool = True,
    catalog: str | None = None,
) -> DataFrame:
    """Take partitions out of the catalog, with their files if ``with_location``.

    ``location`` names the directory that was deleted, ``action`` is ``dropped`` or ``absent``.
    Managed tables lose the files in any case, so there ``with_location`` is a must.
    """
    name = TableName(database, table, catalog)
    wanted = as_specs(partition_kv)
    if not table_exists(spark, name):
        if not ignore_if_not_exist:
            raise NotFound(f"table {name} does not exist")
        return outcome(spark, list(wanted[0]), wanted, [None] * len(wanted), ["absent"] * len(wanted))
    info = partitioned_table(spark, name)
    specs = order_specs(spark, info, wanted)
    held = present(spark, info, specs)
    if not ignore_if_not_exist and not all(held):
        raise NotFound(f"{name} has no partitions {_picked(specs, [not h for h in held])}")
    refuse_managed(info, not with_location)

    there = _picked(specs, held)
    # Looked up one by one, so only if needed.
    places = partition_locations(spark, info, there) if with_location else [None] * len(there)
    if with_location:
        refuse_table_root(spark, info, places)
        refuse_shared(spark, info, there, places)
    drop_from_catalog(spark, info, there)
    if with_location:
        for_each(spark, lambda place: delete_tree(spark, place), places)
    spark.catalog.refreshTable(name.sql)
    place_of = iter(places)
    return outcome(
        spark,
        info.partition_columns,
        specs,
        [next(place_of) if h else None for h in held],
        ["dropped" if h else "absent" for h in held],
    )


def partition_exists(
    spark: SparkSession,
    *,
    database: str,
    table: str,
    partition_kv: Spec | Sequence[Spec],
    with_location: bool = False,
    error_if_not_exist: bool = False,
    catalog: str | None = None,
) -> DataFrame:
    """The keys, ``partition_exists`` and ``location_exists`` for each spec.

    ``location_exists`` is null unless asked for, and false for an absent partition.
    A table that is absent or not partitioned has no partitions.
    """
    name = TableName(database, table, catalog)
    specs = as_specs(partition_kv)
    held, filled, keys = [False] * len(specs), [False] * len(specs), list(specs[0])
    if table_exists(spark, name):
        info = describe_table(spark, name)
        if info.partition_columns:
            specs, keys = order_specs(spark, info, specs), info.partition_columns
            held = present(spark, info, specs)
            if with_location:
                places = partition_locations(spark, info, _picked(specs, held))
                found = iter(for_each(spark, lambda place: has_objects(spark, place), places))
                filled = [h and next(found) for h in held]
    if error_if_not_exist and not all(held):
        raise NotFound(f"{name} has no partitions {_picked(specs, [not h for h in held])}")
    if error_if_not_exist and with_location and not all(filled):
        raise NotFound(f"the partitions {_picked(specs, [not f for f in filled])} of {name} hold no objects")
    columns = {key: pa.array([spec[key] for spec in specs], pa.string()) for key in keys}
    columns["partition_exists"] = pa.array(held, pa.bool_())
    columns["location_exists"] = pa.array(filled if with_location else [None] * len(specs), pa.bool_())
    return spark.createDataFrame(pa.table(columns))


def outcome(
    spark: SparkSession,
    keys: Sequence[str],
    specs: Sequence[Spec],
    places: Sequence[str | None],
    actions: Sequence[str],
) -> DataFrame:
    """What was done with each spec; a key of the name ``location`` or ``action`` keeps its own column."""
    columns = {key: pa.array([spec[key] for spec in specs], pa.string()) for key in keys}
    for name, values in (("location", places), ("action", actions)):
        columns[name if name not in keys else f"partition_{name}"] = pa.array(values, pa.string())
    return spark.createDataFrame(pa.table(columns))


def _locations(info: TableInfo, specs: Sequence[Spec], location: str | Sequence[str | None] | None) -> list[str]:
    given = [location] if isinstance(location, str) else list(location or [None] * len(specs))
    if len(given) != len(specs):
        raise ConfigError(f"{len(given)} locations were given for {len(specs)} partitions")
    return [normalise(place) if place else default_location(info, spec) for place, spec in zip(given, specs)]


def _picked(items: Sequence, flags: Sequence[bool]) -> list:
    return [item for item, flag in zip(items, flags) if flag]


def refuse_managed(info: TableInfo, keeps_files: bool) -> None:
    if info.managed and keeps_files:
        raise ConfigError(f"{info.name} is managed: dropping its partitions would delete their files")


def refuse_table_root(spark: SparkSession, info: TableInfo, places: Sequence[str]) -> None:
    """A partition's directory is replaced or deleted as a whole, so it must not hold the others."""
    whole = for_each(spark, lambda place: holds(spark, place, info.location), places)
    if any(whole):
        raise ConfigError(f"{_picked(places, whole)[0]} holds all of {info.name}, not one partition")


def refuse_shared(spark: SparkSession, info: TableInfo, specs: Sequence[Spec], places: Sequence[str]) -> None:
    """Nor may it hold, or lie in, the directory of a partition that is none of ``specs``."""
    if shared := others_at(spark, info, specs, places):
        raise ConfigError(f"{shared[0]} shares its directory with another partition of {info.name}")
