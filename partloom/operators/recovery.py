"""Bring the targets of calls whose driver died to a whole state."""

from __future__ import annotations

import logging
from datetime import timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from partloom.errors import ConfigError
from partloom.plans.journal import is_dead, journals, recover_one
from partloom.sources.catalog import TableName, database_exists, describe_database, describe_table, table_exists
from partloom.sources.storage import normalise, parent_of

log = logging.getLogger(__name__)

#: A call that runs gives a sign of life every half a minute.
SILENT = timedelta(minutes=5)


def recover(
    spark: SparkSession,
    *,
    database: str,
    table: str | None = None,
    location: str | None = None,
    silent_for: timedelta = SILENT,
    catalog: str | None = None,
) -> DataFrame:
    """Finish what calls of ``ctas``, ``apas`` and ``apas_many`` left behind when their driver died.

    Looked for are journals beside the directory of ``table`` or beside ``location``, and in the directory of the
    database. A call that has given no sign of life for ``silent_for`` counts as dead. Its target becomes all old
    if the switch was not complete, else all new; staged files, scratch tables, leases and the journal go.
    One row per journal comes back: ``what`` was written, the ``journal`` and the ``outcome``: ``old``,
    ``new`` or ``alive``.
    """
    if not database_exists(spark, database, catalog):
        raise ConfigError(f"database {database} does not exist")
    homes = [normalise(describe_database(spark, database, catalog)["location"])]
    name = TableName(database, table, catalog) if table else None
    if name and table_exists(spark, name) and (place := describe_table(spark, name).location):
        homes.append(parent_of(spark, place))
    if location:
        homes.append(parent_of(spark, location))
    told = []
    for journal in journals(spark, homes):
        what = journal.facts().get("claimed", {}).get("what", "")
        outcome = "alive"
        if is_dead(journal, round(silent_for.total_seconds() * 1000)):
            outcome = recover_one(journal) or "alive"
            log.warning("%s: recovered to %s", what, outcome)
        told.append((what, journal.folder, outcome))
    if name and table_exists(spark, name):
        spark.catalog.refreshTable(name.sql)
    columns = zip(("what", "journal", "outcome"), zip(*told) if told else ((), (), ()))
    return spark.createDataFrame(pa.table({column: pa.array(values, pa.string()) for column, values in columns}))
