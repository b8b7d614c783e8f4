"""When tables were last read by the operators: a file beside each table, whose time tells.

Spark's built-in catalog keeps no access time, and file systems mostly keep none either. ``query``, ``ctas`` and
``apas`` note the tables of the statements they run; other readers are not seen.
"""

from __future__ import annotations

import hashlib
import logging
import time
from datetime import datetime, timezone

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from partloom.errors import StorageError
from partloom.sources.storage import create_new, exists, for_each, full_name, modified_millis, normalise, parent_of, touch

log = logging.getLogger(__name__)

#: Seconds in which a table is noted once at most.
OFTEN = 10


def _note_of(spark: SparkSession, location: str) -> str:
    place = full_name(spark, normalise(location))
    return f"{parent_of(spark, place)}_access.{hashlib.sha1(place.encode()).hexdigest()[:20]}"


def tables_read(frame: DataFrame) -> set[str]:
    """The locations of the catalog's tables that a plan reads, through views and subqueries as well."""
    return _read(frame._jdf.queryExecution().analyzed())


def _read(plan) -> set[str]:
    found = set()
    if plan.nodeName() == "LogicalRelation" and plan.catalogTable().isDefined():
        table = plan.catalogTable().get()
        if table.storage().locationUri().isDefined():
            found.add(table.location().toString())
    for below in (plan.children(), plan.subqueries()):
        for i in range(below.size()):
            found |= _read(below.apply(i))
    return found


def note_access(frame: DataFrame) -> DataFrame:
    """Note that the tables of the statement are read. A note that cannot be written stops nothing."""
    spark = frame.sparkSession
    try:
        for_each(spark, lambda place: _touch(spark, _note_of(spark, place)), sorted(tables_read(frame)))
    except (Py4JError, StorageError) as error:
        log.warning("the access to tables could not be noted: %s", error)
    return frame


def _touch(spark: SparkSession, file: str) -> None:
    now = int(time.time() * 1000)
    if not exists(spark, file):
        create_new(spark, file, "")
    elif now - modified_millis(spark, file) > OFTEN * 1000:
        touch(spark, file, now)


def last_access(spark: SparkSession, location: str | None) -> datetime | None:
    """When the table there was last noted."""
    if location is None or not exists(spark, file := _note_of(spark, location)):
        return None
    return datetime.fromtimestamp(modified_millis(spark, file) / 1000, timezone.utc)
