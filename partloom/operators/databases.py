"""List databases and run the same work over each."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType, TimestampType

from partloom.errors import ConfigError
from partloom.plans.layout import union
from partloom.sources.catalog import describe_database, quote
from partloom.sources.storage import for_each

_INVENTORY = StructType(
    [
        StructField("name", StringType(), False),
        StructField("created_at", TimestampType()),
        StructField("description", StringType()),
        StructField("location", StringType()),
        StructField("parameters", MapType(StringType(), StringType())),
    ]
)


@dataclass(frozen=True)
class Database:
    name: str
    created_at: datetime | None
    description: str | None
    location: str | None
    parameters: dict[str, str]


def list_databases(spark: SparkSession, *, regexp: str | None = None, catalog: str | None = None) -> list[Database]:
    """Databases in name order; with ``regexp`` only those whose whole name matches."""
    found = spark.sql("SHOW DATABASES" + (f" IN {quote(catalog)}" if catalog else ""))
    names = sorted(row[0] for row in found.collect())
    if regexp is not None:
        names = [name for name in names if re.fullmatch(regexp, name)]
    return for_each(spark, lambda name: Database(**describe_database(spark, name, catalog)), names)


def database_inventory(spark: SparkSession, *, regexp: str | None = None, catalog: str | None = None) -> DataFrame:
    """``name, created_at, description, location, parameters``; Spark keeps no creation time."""
    rows = [tuple(vars(d).values()) for d in list_databases(spark, regexp=regexp, catalog=catalog)]
    return spark.createDataFrame(rows, _INVENTORY)


def for_each_database(
    spark: SparkSession,
    body: Callable[[Database], DataFrame | None],
    *,
    regexp: str | None = None,
    catalog: str | None = None,
    parallel: int = 1,
) -> DataFrame:
    """The DataFrames that ``body`` gives for each database, as one with a ``database`` column.

    They become branches of a single plan, which Spark runs side by side. A body
    that only acts and gives None adds no rows. ``parallel`` bodies are at work at a time.
    """
    if parallel < 1:
        raise ConfigError(f"parallel is {parallel}, it must be 1 or more")

    def run(database: Database) -> DataFrame | None:
        frame = body(database)
        return None if frame is None else frame.withColumn("database", F.lit(database.name))

    results = for_each(spark, run, list_databases(spark, regexp=regexp, catalog=catalog), parallel)
    frames = [frame for frame in results if frame is not None]
    if not frames:
        return spark.createDataFrame([], StructType([StructField("database", StringType())]))
    return union(frames)
