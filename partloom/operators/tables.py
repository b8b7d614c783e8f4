"""Drop and check tables, one or a set per call."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partloom.errors import ConfigError, NotFound
from partloom.sources.access import last_access
from partloom.sources.catalog import (
    TableInfo,
    TableName,
    database_exists,
    describe_table,
    drop_name,
    quote,
)
from partloom.sources.storage import delete_tree, for_each, has_objects, newest_file

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Protect:
    """Tables that ``drop_table_multi`` leaves alone: those used within a time from now."""

    created_within: timedelta | None = None
    updated_within: timedelta | None = None
    accessed_within: timedelta | None = None


def table_exists(
    spark: SparkSession,
    *,
    database: str,
    table: str | Sequence[str],
    with_location: bool = False,
    error_if_not_exist: bool = False,
    catalog: str | None = None,
) -> DataFrame:
    """``database, table, table_exists, location_exists`` for each name.

    ``location_exists`` is null unless asked for, and false for an absent table.
    """
    names = _names(database, table, catalog)
    held = _held(spark, names)
    if error_if_not_exist and not all(held):
        raise NotFound(f"no such tables: {[str(n) for n, h in zip(names, held) if not h]}")
    filled: list[bool | None] = [None] * len(names)
    if with_location:
        filled = for_each(
            spark,
            lambda pair: pair[1] and has_objects(spark, describe_table(spark, pair[0]).location),
            zip(names, held),
        )
        if error_if_not_exist and not all(filled):
            raise NotFound(f"tables without objects: {[str(n) for n, f in zip(names, filled) if not f]}")
    return spark.createDataFrame(
        pa.table(
            {
                "database": pa.array([n.database for n in names], pa.string()),
                "table": pa.array([n.table for n in names], pa.string()),
                "table_exists": pa.array(held, pa.bool_()),
                "location_exists": pa.array(filled, pa.bool_()),
            }
        )
    )


def drop_table(
    spark: SparkSession,
    *,
    database: str,
    table: str | Sequence[str],
    with_location: bool = False,
    ignore_if_not_exist: bool = True,
    catalog: str | None = None,
) -> DataFrame:
    """Drop tables, with their files if ``with_location``: ``database, table, location, action``.

    Managed tables lose their files in any case, so there ``with_location`` is a must.
    """
    names = _names(database, table, catalog)
    held = _held(spark, names)
    if not ignore_if_not_exist and not all(held):
        raise NotFound(f"no such tables: {[str(n) for n, h in zip(names, held) if not h]}")
    infos = for_each(spark, lambda name: describe_table(spark, name), [n for n, h in zip(names, held) if h])
    _drop(spark, infos, with_location)
    places = {info.name: info.location for info in infos}
    return _report(spark, names, places, ["dropped" if h else "absent" for h in held])


def drop_table_multi(
    spark: SparkSession,
    *,
    database: str,
    regexp: str,
    limit: int | None = None,
    protect: Protect | None = None,
    with_location: bool = False,
    catalog: str | None = None,
) -> DataFrame:
    """Drop the tables whose whole name matches ``regexp``, except protected ones.

    ``limit`` counts the matching names in order, before protection is looked at.
    The last access is what the catalog tells, or the last read by ``query``, ``ctas`` or ``apas``; a table of
    which neither is known is not protected by it.
    """
    now = datetime.now(timezone.utc)
    if not regexp:
        raise ConfigError("regexp is required")
    if not database_exists(spark, database, catalog):
        raise NotFound(f"database {database} does not exist")
    matching = (
        list_tables(spark, database, catalog).where(F.col("table").rlike(f"^(?:{regexp})$")).orderBy("table")
    )
    if limit is not None:
        matching = matching.limit(limit)
    names = [TableName(database, row["table"], catalog) for row in matching.collect()]
    infos = for_each(spark, lambda name: describe_table(spark, name), names)
    kept = for_each(spark, lambda info: _is_protected(spark, info, protect or Protect(), now), infos)
    _drop(spark, [info for info, keep in zip(infos, kept) if not keep], with_location)
    places = {info.name: info.location for info in infos}
    return _report(spark, names, places, ["protected" if keep else "dropped" for keep in kept])


def list_tables(spark: SparkSession, database: str, catalog: str | None = None) -> DataFrame:
    """The tables (not the views of the session) of a database, one ``table`` per row."""
    place = ".".join(quote(p) for p in (catalog, database) if p)
    return spark.sql(f"SHOW TABLES IN {place}").where(~F.col("isTemporary")).select(F.col("tableName").alias("table"))


def _is_protected(spark: SparkSession, info: TableInfo, protect: Protect, now: datetime) -> bool:
    def within(moment: datetime | None, span: timedelta | None) -> bool:
        return moment is not None and span is not None and moment > now - span

    if within(info.created_at, protect.created_within):
        return True
    if protect.updated_within is not None:
        # Creating a table is its first update; later ones show in its files.
        if within(info.created_at, protect.updated_within):
            return True
        if info.location and _has_files_since(spark, info, now - protect.updated_within):
            return True
    if protect.accessed_within is None:
        return False
    told = [moment for moment in (info.accessed_at, last_access(spark, info.location)) if moment]
    if not told:
        log.warning("%s: last access unknown, not protected by it", info.name)
    return any(within(moment, protect.accessed_within) for moment in told)


def _has_files_since(spark: SparkSession, info: TableInfo, moment: datetime) -> bool:
    """Whether a file of the table or of its partitions was written after ``moment``.

    Listings tell, so a table that was emptied a moment ago counts as updated and no file is opened.
    """
    if newest_file(spark, info.location, int(moment.timestamp() * 1000)):
        return True
    if not info.partition_columns:
        return False
    # Partitions may lie elsewhere; Spark leaves out the older files before it reads.
    spark.catalog.refreshTable(info.name.sql)
    changed = F.col("_metadata.file_modification_time") > F.lit(moment)
    return not spark.table(info.name.sql).where(changed).isEmpty()


def _names(database: str, table: str | Sequence[str], catalog: str | None) -> list[TableName]:
    tables = [table] if isinstance(table, str) else list(table)
    return [TableName(database, name, catalog) for name in tables]


def _held(spark: SparkSession, names: Sequence[TableName]) -> list[bool]:
    if not names or not database_exists(spark, names[0].database, names[0].catalog):
        return [False] * len(names)
    return for_each(spark, lambda name: spark.catalog.tableExists(name.sql), names)


def _drop(spark: SparkSession, infos: Sequence[TableInfo], with_location: bool) -> None:
    managed = [str(info.name) for info in infos if info.managed]
    if managed and not with_location:
        raise ConfigError(f"dropping managed tables would delete their files: {managed}")
    for_each(spark, lambda info: drop_name(spark, info), infos)
    if with_location:
        for_each(spark, lambda info: delete_tree(spark, info.location), infos)


def _report(
    spark: SparkSession, names: Sequence[TableName], places: dict[TableName, str], actions: Sequence[str]
) -> DataFrame:
    return spark.createDataFrame(
        pa.table(
            {
                "database": pa.array([n.database for n in names], pa.string()),
                "table": pa.array([n.table for n in names], pa.string()),
                "location": pa.array([places.get(n) for n in names], pa.string()),
                "action": pa.array(actions, pa.string()),
            }
        )
    )
