"""Databases, tables and partitions as the session's catalog describes them."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from partloom.errors import ConfigError, PartlyDone
from partloom.sources.storage import for_each, normalise

# Fixed value: how Spark names the directory of a null key.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Characters that Spark writes as %XX in a partition directory,
# besides the control characters.
_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^")

# Column that numbers requested specs, next to columns named by the author's keys.
_POSITION = "__position__"

# Specs named in one ALTER TABLE statement.
_SPECS_PER_STATEMENT = 500

Spec = Mapping[str, str]


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


@dataclass(frozen=True)
class TableName:
    database: str
    table: str
    catalog: str | None = None

    @property
    def sql(self) -> str:
        return ".".join(quote(p) for p in (self.catalog, self.database, self.table) if p)

    @property
    def in_session(self) -> str:
        """The name for statements that know the session catalog only."""
        return f"{quote(self.database)}.{quote(self.table)}"

    def require_session_catalog(self) -> None:
        if self.catalog not in (None, "spark_catalog"):
            raise ConfigError(f"tables of the catalog {self.catalog} cannot be replaced, only those of spark_catalog")

    def sibling(self, prefix: str) -> TableName:
        """A name in the same database that nothing else uses."""
        return TableName(self.database, unique_name(prefix), self.catalog)

    def __str__(self) -> str:
        return ".".join(p for p in (self.catalog, self.database, self.table) if p)


@dataclass(frozen=True)
class TableInfo:
    name: TableName
    kind: str
    location: str | None
    provider: str
    serde: str | None
    partition_columns: tuple[str, ...]
    bucket_columns: tuple[str, ...] = ()
    bucket_count: int | None = None
    sort_columns: tuple[str, ...] = ()
    storage_properties: Mapping[str, str] = field(default_factory=dict)
    table_properties: Mapping[str, str] = field(default_factory=dict)
    created_at: datetime | None = None
    accessed_at: datetime | None = None

    @property
    def managed(self) -> bool:
        """Whether Spark deletes the files when the table or a partition is dropped."""
        return self.kind == "MANAGED"


# --- databases ---------------------------------------------------------------


def database_exists(spark: SparkSession, database: str, catalog: str | None = None) -> bool:
    return spark.catalog.databaseExists(".".join(quote(p) for p in (catalog, database) if p))


def describe_database(spark: SparkSession, database: str, catalog: str | None = None) -> dict:
    """Name, comment, location and properties; Spark's catalog keeps no creation time."""
    name = ".".join(quote(p) for p in (catalog, database) if p)
    facts = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {name}").collect()}
    return {
        "name": database,
        "created_at": None,
        "description": facts.get("Comment") or None,
        "location": facts.get("Location"),
        "parameters": _properties(spark, name, facts),
    }


# Properties that Spark keeps for itself.
_RESERVED_PROPERTIES = ("comment", "location", "owner", "collation")


def _properties(spark: SparkSession, name: str, facts: Mapping[str, str]) -> dict[str, str]:
    """The properties of a database of the session's catalog as it keeps them; of others, as they are printed."""
    try:
        state = spark._jsparkSession.sessionState()
        parts = state.sqlParser().parseMultipartIdentifier(name)
        if parts.size() == 1 or parts.apply(0) == "spark_catalog":
            kept = state.catalog().getDatabaseMetadata(parts.last()).properties().toSeq()
            pairs = (kept.apply(i) for i in range(kept.size()))
            return {p._1(): p._2() for p in pairs if p._1() not in _RESERVED_PROPERTIES}
    except Py4JError:
        pass
    return _pairs(facts.get("Properties") or "")


def _pairs(text: str) -> dict[str, str]:
    """``((k,v), (k2,v2))`` as a mapping; a value may itself hold commas and ``), (`` without a comma after it."""
    inner = text.strip()
    if not inner.startswith("(("):
        return {}
    return dict(pair.split(",", 1) for pair in re.split(r"\), \((?=[^(),]+,)", inner[2:-2]))


# --- tables ------------------------------------------------------------------


def table_exists(spark: SparkSession, name: TableName) -> bool:
    """False only when the table is absent; any other failure is raised."""
    return database_exists(spark, name.database, name.catalog) and spark.catalog.tableExists(name.sql)


def describe_table(spark: SparkSession, name: TableName) -> TableInfo:
    facts = json.loads(spark.sql(f"DESCRIBE EXTENDED {name.sql} AS JSON").collect()[0][0])
    return TableInfo(
        name=name,
        kind=facts.get("type", ""),
        location=normalise(facts["location"]) if facts.get("location") else None,
        provider=facts.get("provider", "").lower(),
        serde=facts.get("serde_library"),
        partition_columns=tuple(facts.get("partition_columns", ())),
        bucket_columns=tuple(facts.get("bucket_columns") or ()),
        bucket_count=int(facts["num_buckets"]) if facts.get("bucket_columns") else None,
        sort_columns=tuple(facts.get("sort_columns") or ()),
        storage_properties=facts.get("storage_properties", {}),
        table_properties=facts.get("table_properties", {}),
        created_at=_time(facts.get("created_time")),
        accessed_at=_time(facts.get("last_access")),
    )


def _time(text: str | None) -> datetime | None:
    if not text or text == "UNKNOWN":
        return None
    return datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc)


def drop_name(spark: SparkSession, info: TableInfo) -> None:
    """Take a table or a view out of the catalog."""
    spark.sql(drop_statement(info))


def drop_statement(info: TableInfo) -> str:
    return f"DROP {'VIEW' if info.kind == 'VIEW' else 'TABLE'} IF EXISTS {info.name.sql}"


def define_like(spark: SparkSession, name: TableName, like: TableName, location: str, properties: Mapping[str, str]) -> None:
    """An empty external table with the columns, format and division of another one."""
    pairs = ", ".join(f"{literal(k)} = {literal(str(v))}" for k, v in properties.items())
    given = f"TBLPROPERTIES ({pairs})" if pairs else ""
    spark.sql(f"CREATE TABLE {name.in_session} LIKE {like.in_session} {given} LOCATION {literal(location)}")


def partitioned_table(spark: SparkSession, name: TableName) -> TableInfo:
    """The table, or a ConfigError when it cannot take partitions."""
    if not database_exists(spark, name.database, name.catalog):
        raise ConfigError(f"database {name.database} does not exist")
    if not spark.catalog.tableExists(name.sql):
        raise ConfigError(f"table {name} does not exist")
    info = describe_table(spark, name)
    if not info.partition_columns:
        raise ConfigError(f"table {name} is not partitioned")
    return info


def data_columns(spark: SparkSession, info: TableInfo) -> StructType:
    """The columns kept in files, that is without the partition keys."""
    keys = {key.lower() for key in info.partition_columns}
    schema = spark.table(info.name.sql).schema
    return StructType([f for f in schema.fields if f.name.lower() not in keys])


def key_types(spark: SparkSession, info: TableInfo) -> dict[str, DataType]:
    schema = spark.table(info.name.sql).schema
    return {key: schema[key].dataType for key in info.partition_columns}


# --- partitions --------------------------------------------------------------


def as_specs(partition_kv: Spec | Sequence[Spec]) -> list[Spec]:
    return [partition_kv] if isinstance(partition_kv, Mapping) else list(partition_kv)


def order_specs(spark: SparkSession, info: TableInfo, specs: Sequence[Spec]) -> list[dict[str, str]]:
    """Every spec in the table's key order, its values as Spark prints them.

    A key that is missing is an error, one the table does not have is ignored.
    ``05`` given for an int key becomes ``5``; ``__HIVE_DEFAULT_PARTITION__`` names the null partition.
    """
    ordered = []
    for spec in specs:
        missing = [key for key in info.partition_columns if spec.get(key) is None]
        if missing:
            raise ConfigError(f"{info.name} is partitioned by {missing}, which {dict(spec)} lacks")
        ordered.append({key: str(spec[key]) for key in info.partition_columns})
    types = key_types(spark, info)
    if ordered and any(t.typeName() != "string" for t in types.values()):
        typed = spec_frame(spark, info.partition_columns, ordered).select(
            _POSITION, *(_typed(key, types[key]).alias(key) for key in types)
        )
        rows = sorted(typed.collect(), key=lambda row: row[_POSITION])
        ordered = [{key: row[key] for key in types} for row in rows]
    if len({tuple(spec.values()) for spec in ordered}) < len(ordered):
        raise ConfigError("the same partition is named twice")
    return ordered


def spec_frame(spark: SparkSession, keys: Sequence[str], specs: Sequence[Spec]) -> DataFrame:
    """Requested specs as rows: their position in the request, then the keys."""
    columns = {_POSITION: pa.array(range(len(specs)), pa.int32())}
    columns |= {key: pa.array([spec[key] for spec in specs], pa.string()) for key in keys}
    return spark.createDataFrame(pa.table(columns))


def _typed(key: str, kind: DataType) -> Column:
    """A value as its key's type prints it; the name of the null partition stays."""
    return F.when(_column(key) == NULL_PARTITION, _column(key)).otherwise(_column(key).cast(kind).cast("string"))


def _column(name: str) -> Column:
    return F.col(quote(name))


def partition_clause(spec: Spec) -> str:
    def value(text: str) -> str:
        return "null" if text == NULL_PARTITION else literal(text)

    return "PARTITION (" + ", ".join(f"{quote(k)}={value(v)}" for k, v in spec.items()) + ")"


def escape_value(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in value)


def default_location(info: TableInfo, spec: Spec) -> str:
    """``<table location>/<key>=<value>/…/`` in the spelling Spark's readers expect."""
    inner = "/".join(f"{escape_value(k)}={escape_value(v)}" for k, v in spec.items())
    return normalise(info.location + inner)


def list_partitions(spark: SparkSession, info: TableInfo) -> DataFrame:
    """One row per partition, one unescaped string column per key."""
    parts = F.split("partition", "/")

    def value(position: int) -> Column:
        raw = F.substring_index(parts[position], "=", -1)
        # url_decode reads + as a blank, which Spark does not escape.
        return F.when(raw != NULL_PARTITION, F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))))

    return spark.sql(f"SHOW PARTITIONS {info.name.sql}").select(
        *(value(i).alias(key) for i, key in enumerate(info.partition_columns))
    )


def present(spark: SparkSession, info: TableInfo, specs: Sequence[Spec]) -> list[bool]:
    """Which of the specs, as given by ``order_specs``, the catalog holds."""

    def held(spec: Spec) -> bool:
        # Spark has no partition with an empty value: it keeps such rows under the null one.
        if "" in spec.values():
            return False
        return has_spec(spark, info.name, spec)

    # Each is asked for by its name: a listing would bring all partitions of the table here.
    return for_each(spark, held, specs)


def partition_locations(spark: SparkSession, info: TableInfo, specs: Sequence[Spec]) -> list[str]:
    """Where each of these existing partitions lies."""

    return for_each(spark, lambda spec: location_of(spark, info.name, spec), specs)


def spec_of(info: TableInfo, values: Mapping[str, str]) -> dict[str, str] | None:
    """The values in the table's key order, or None where they are not its keys."""
    return {key: values[key] for key in info.partition_columns} if set(values) == set(info.partition_columns) else None


def every_location(spark: SparkSession, info: TableInfo) -> list[tuple[dict[str, str], str]]:
    """Every partition of the table and where it lies: one call to the catalog.

    Spark's SQL tells locations one partition at a time, which a table of many has no time for.
    """
    state, jvm = spark._jsparkSession.sessionState(), spark.sparkContext._jvm
    name = state.sqlParser().parseTableIdentifier(info.name.in_session)
    end = f"\n{uuid.uuid4().hex}\n"
    text = state.catalog().listPartitions(name, jvm.scala.Option.empty()).mkString(end)
    between = r"Partition Values: \[" + ", ".join(f"{re.escape(key)}=(.*)" for key in info.partition_columns)
    pattern = re.compile(between + r"\]\n\tLocation: ([^\n]*)", re.DOTALL)
    found = []
    for part in text.split(end) if text else []:
        *values, place = pattern.search(part).groups()
        found.append((dict(zip(info.partition_columns, values)), normalise(place)))
    return found


def add_to_catalog(spark: SparkSession, info: TableInfo, specs: Sequence[Spec], locations: Sequence[str]) -> None:
    # Above _SPECS_PER_STATEMENT these are several statements; one that fails says what went before it.
    clauses = [f"{partition_clause(s)} LOCATION {literal(l)}" for s, l in zip(specs, locations)]
    _alter(spark, f"ALTER TABLE {info.name.sql} ADD ", " ", clauses)


def move_in_catalog(spark: SparkSession, info: TableInfo, spec: Spec, location: str) -> None:
    alter_location(spark, info.name, spec, location)


def drop_from_catalog(spark: SparkSession, info: TableInfo, specs: Sequence[Spec]) -> None:
    _alter(spark, f"ALTER TABLE {info.name.sql} DROP IF EXISTS ", ", ", [partition_clause(spec) for spec in specs])


def has_spec(spark: SparkSession, name: TableName, spec: Spec) -> bool:
    return not spark.sql(f"SHOW PARTITIONS {name.sql} {partition_clause(spec)}").isEmpty()


def location_of(spark: SparkSession, name: TableName, spec: Spec) -> str:
    text = spark.sql(f"DESCRIBE EXTENDED {name.sql} {partition_clause(spec)} AS JSON").collect()[0][0]
    return normalise(json.loads(text)["location"])


def add_spec(spark: SparkSession, name: TableName, spec: Spec, location: str) -> None:
    spark.sql(f"ALTER TABLE {name.sql} ADD IF NOT EXISTS {partition_clause(spec)} LOCATION {literal(location)}")


def alter_location(spark: SparkSession, name: TableName, spec: Spec, location: str) -> None:
    spark.sql(f"ALTER TABLE {name.sql} {partition_clause(spec)} SET LOCATION {literal(location)}")


def drop_spec(spark: SparkSession, name: TableName, spec: Spec) -> None:
    spark.sql(f"ALTER TABLE {name.sql} DROP IF EXISTS {partition_clause(spec)}")


def _alter(spark: SparkSession, statement: str, separator: str, clauses: list[str]) -> None:
    for done in range(0, len(clauses), _SPECS_PER_STATEMENT):
        batch = clauses[done : done + _SPECS_PER_STATEMENT]
        try:
            spark.sql(statement + separator.join(batch))
        except Exception as error:
            if done:
                raise PartlyDone(f"{done} of {len(clauses)} partitions were done, in the order given") from error
            raise
