"""Create a table, or only its files, from a SELECT."""

from __future__ import annotations

import logging
import os
import re
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from partloom.errors import AlreadyExists, ConfigError, StorageError
from partloom.plans.journal import Journal, writing
from partloom.plans.layout import for_table, rebalance as rebalance_rows
from partloom.plans.limits import TEN_MINUTES, time_limit
from partloom.sources.catalog import (
    NULL_PARTITION,
    TableInfo,
    TableName,
    add_to_catalog,
    default_location,
    define_like,
    describe_database,
    describe_table,
    drop_name,
    drop_statement,
    every_location,
    list_partitions,
    literal,
    quote,
    table_exists,
    unique_name,
)
from partloom.sources.formats import Storage, holds_line_end, in_lines, splittable, storage_for
from partloom.sources.sqltext import select_frame
from partloom.sources.storage import (
    aside_of,
    delete_beside,
    delete_tree,
    exists,
    fresh_below,
    has_objects,
    is_vacant,
    normalise,
    overlapping,
    same_place,
    staging_beside,
    swapped,
)

log = logging.getLogger(__name__)

TABLE_MODES = ("default", "empty", "data_only")
SAVE_MODES = ("none", "error_if_exists", "ignore", "overwrite")


@dataclass(frozen=True)
class Layout:
    """How the files of a table are divided."""

    partitioned_by: Sequence[str] = ()
    bucketed_by: Sequence[str] = ()
    bucket_count: int | None = None
    sorted_by: Sequence[str] = ()

    def __post_init__(self):
        if isinstance(self.partitioned_by, str) or isinstance(self.bucketed_by, str):
            raise ConfigError("partitioned_by and bucketed_by take a list of columns")
        if self.bucketed_by and not self.bucket_count:
            raise ConfigError("bucketed_by needs bucket_count")


@dataclass(frozen=True)
class CtasResult:
    """``frame`` reads what lies at ``location``; ``created`` is False when the call was skipped."""

    table: TableName
    location: str
    created: bool
    frame: DataFrame = field(repr=False)


def ctas(
    spark: SparkSession,
    select: str | os.PathLike,
    *,
    database: str = "default",
    table: str | None = None,
    location: str | None = None,
    format: str = "parquet",
    compression: str = "snappy",
    field_delimiter: str | None = None,
    partitioned_by: Sequence[str] = (),
    bucketed_by: Sequence[str] = (),
    bucket_count: int | None = None,
    additional_properties: Mapping[str, str] | None = None,
    table_mode: str = "default",
    save_mode: str = "overwrite",
    rebalance: bool | None = None,
    relocate: bool = False,
    params: Mapping | None = None,
    args: Mapping | list | None = None,
    timeout: timedelta | None = TEN_MINUTES,
    catalog: str | None = None,
) -> CtasResult:
    """Run ``select`` and keep its rows as an external table.

    Without a ``location`` every call gets a fresh directory below that of the
    database. With ``overwrite`` the rows are written aside first, so a SELECT
    may read the table it replaces and a failing one leaves it untouched.
    ``rebalance`` puts a shuffle before the write so that files are of even size;
    by default that is done when the table is partitioned or bucketed, and for text files with
    strings, each of which one task must read.

    ``relocate`` never moves files: the rows go to a new directory below ``location``, the name is
    switched to it, and what else lies in ``location`` is deleted last. That is the way for object
    stores, where moving a directory copies it. The time limit covers the job that writes.
    """
    choose("table_mode", table_mode, TABLE_MODES)
    choose("save_mode", save_mode, SAVE_MODES)
    layout = Layout(partitioned_by, bucketed_by, bucket_count)
    name = TableName(database, table or unique_name("ctas"), catalog)
    if save_mode == "overwrite" or table_mode == "empty":
        name.require_session_catalog()
    if relocate and (location is None or save_mode != "overwrite" or table_mode == "empty"):
        raise ConfigError("relocate replaces the rows at a given location, with save_mode 'overwrite'")
    target = normalise(location) if location else fresh_location(spark, name)
    with writing(spark, [target], what=f"{target}") as journal:
        return _ctas(
            spark, name, target, journal, select, location is not None, format, compression, field_delimiter, layout,
            additional_properties or {}, table_mode, save_mode, rebalance, relocate, params, args, timeout,
        )


def _ctas(
    spark: SparkSession, name: TableName, target: str, journal: Journal, select: str | os.PathLike, placed: bool, format: str,
    compression: str, field_delimiter: str | None, layout: Layout, properties: Mapping[str, str], table_mode: str, save_mode: str,
    rebalance: bool | None, relocate: bool, params: Mapping | None, args: Mapping | list | None, timeout: timedelta | None,
) -> CtasResult:
    old = describe_table(spark, name) if table_exists(spark, name) else None
    occupied = placed and has_objects(spark, target)

    if save_mode == "error_if_exists" and old:
        raise AlreadyExists(f"table {name} already exists")
    if save_mode == "error_if_exists" and occupied:
        raise AlreadyExists(f"location {target} already holds objects")
    if save_mode == "ignore" and old:
        log.info("table %s already exists, nothing done", name)
        return CtasResult(name, old.location, False, spark.table(name.sql))
    frame = select_frame(spark, select, params=params, args=args, database=name.database, catalog=name.catalog)
    storage = storage_for(format, frame.schema, compression, field_delimiter)
    if save_mode == "ignore" and occupied:
        log.info("location %s already holds objects, nothing done", target)
        return CtasResult(name, target, False, read_files(spark, target, storage, frame))

    if table_mode == "empty":
        rows = frame.limit(0)
    elif rebalance is False:
        rows = frame
    else:
        rows = for_table(frame, layout.partitioned_by, layout.bucketed_by, layout.bucket_count)
        if rows is frame and (rebalance or storage.unsplittable):
            rows = rebalance_rows(frame)
    # An empty table must be able to take any text.
    ways = [storage] if table_mode == "empty" else splittable(storage)
    write = Write(rows, storage, layout, properties, timeout, ways)
    if save_mode == "overwrite" and placed and not is_vacant(spark, target):
        refuse_other_tables(spark, name, target)

    if table_mode == "data_only":
        target = _data_only(spark, write, name, target, old, save_mode, relocate, journal)
        return CtasResult(name, target, True, read_files(spark, target, write.storage, frame))
    if table_mode == "empty":
        _empty(spark, write, name, target, old, save_mode, journal)
    elif save_mode == "none" or (not old and not relocate and is_vacant(spark, target)):
        _plain(spark, write, name, target, save_mode, journal)
    elif relocate:
        target = _relocate(spark, write, name, target, old, journal)
    else:
        _replace(spark, write, name, target, old, journal)
    spark.catalog.refreshTable(name.sql)
    return CtasResult(name, target, True, spark.table(name.sql))


def choose(option: str, value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ConfigError(f"{option} '{value}' is not supported, use one of {list(allowed)}")


def fresh_location(spark: SparkSession, name: TableName) -> str:
    home = describe_database(spark, name.database, name.catalog)["location"]
    return normalise(normalise(home) + unique_name(name.table))


def read_files(spark: SparkSession, location: str, storage: Storage, like: DataFrame) -> DataFrame:
    return spark.read.format(storage.provider).options(**storage.options).schema(like.schema).load(location)


@dataclass
class Write:
    """The rows of a SELECT together with how they are to be stored.

    ``ways`` are to be tried in turn; the one that holds the rows is ``storage`` from then on.
    """

    rows: DataFrame
    storage: Storage
    layout: Layout = Layout()
    properties: Mapping[str, str] = field(default_factory=dict)
    timeout: timedelta | None = None
    ways: Sequence[Storage] = ()

    def create(self, spark: SparkSession, name: TableName, location: str) -> None:
        """CREATE TABLE AS SELECT: the one job that moves rows, within the time limit."""
        ways = list(self.ways) or [self.storage]
        for way in ways:
            rows = in_lines(self.rows, way, self.layout.partitioned_by)
            try:
                with time_limit(spark, self.timeout):
                    replace(self, rows=rows, storage=way)._create(name, location)
                self.storage = way
                return
            except Exception as error:
                if not holds_line_end(error):
                    raise
                if way is ways[-1]:
                    raise ConfigError(f"a value holds the character that ends the lines of {location}") from error
                log.info("%s: lines cannot end with %r, a value holds it", name, way.line_end)
                # The check runs before the first row of a file is closed, so nothing there is of use.
                delete_tree(spark, location)

    def _create(self, name: TableName, location: str) -> None:
        # The rows may belong to a session with a current database of its own.
        session = self.rows.sparkSession
        view = unique_name("select")
        self.rows.createOrReplaceTempView(view)
        try:
            session.sql(
                " ".join(
                    [
                        f"CREATE TABLE {name.sql} USING {self.storage.provider}",
                        _listed("OPTIONS", self.storage.options),
                        self._division(),
                        f"LOCATION {literal(location)}",
                        _listed("TBLPROPERTIES", self.properties),
                        f"AS SELECT * FROM {quote(view)}",
                    ]
                )
            )
        except AnalysisException as error:
            if self.storage.provider == "avro" and "avro" in str(error).lower():
                raise ConfigError("format 'avro' needs the spark-avro package on the session's classpath") from error
            raise
        finally:
            session.catalog.dropTempView(view)

    @contextmanager
    def scratch(self, spark: SparkSession, name: TableName, location: str, journal: Journal):
        """The rows as a table of another name, gone when the block ends; its files stay."""
        scratch = name.sibling("scratch")
        journal.say("staging", directories=[location], scratch=[scratch.sql])
        try:
            self.create(spark, scratch, location)
            yield scratch
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {scratch.sql}")

    def define_like(self, spark: SparkSession, name: TableName, like: TableName, location: str) -> None:
        define_like(spark, name, like, location, self.properties)

    def _division(self) -> str:
        clauses = []
        if self.layout.partitioned_by:
            clauses.append(f"PARTITIONED BY ({', '.join(map(quote, self.layout.partitioned_by))})")
        if self.layout.bucketed_by:
            columns = ", ".join(map(quote, self.layout.bucketed_by))
            order = f"SORTED BY ({', '.join(map(quote, self.layout.sorted_by))}) " if self.layout.sorted_by else ""
            clauses.append(f"CLUSTERED BY ({columns}) {order}INTO {self.layout.bucket_count} BUCKETS")
        return " ".join(clauses)


def _listed(keyword: str, pairs: Mapping[str, str]) -> str:
    if not pairs:
        return ""
    return f"{keyword} (" + ", ".join(f"{literal(k)} = {literal(str(v))}" for k, v in pairs.items()) + ")"


# A line of what Spark tells of a table.
_LOCATION = re.compile(r"^Location: (.*)$", re.MULTILINE)


def refuse_other_tables(spark: SparkSession, name: TableName, target: str) -> None:
    """A directory is replaced as a whole, so it must not hold, or lie in, that of another table."""
    # One statement tells of all tables of the database.
    told = spark.sql(f"SHOW TABLE EXTENDED IN {quote(name.database)} LIKE '*'").where("NOT isTemporary")
    for row in told.select("tableName", "information").collect():
        place = _LOCATION.search(row["information"])
        if row["tableName"].lower() != name.table.lower() and place and overlapping(spark, [target], [place[1]]):
            raise ConfigError(f"{target} shares its directory with the table {TableName(name.database, row['tableName'])}")


def _plain(spark: SparkSession, write: Write, name: TableName, target: str, save_mode: str, journal: Journal) -> None:
    """CREATE TABLE AS SELECT where nothing stands in the way, or where Spark shall say so."""
    if save_mode != "none":
        # The entry comes with the last file: until then what is there is not a table.
        journal.say("staging", directories=[target], scratch=[])
    write.create(spark, name, target)
    if save_mode != "none":
        journal.say("cleaning")


def _data_only(
    spark: SparkSession,
    write: Write,
    name: TableName,
    target: str,
    old: TableInfo | None,
    save_mode: str,
    relocate: bool,
    journal: Journal,
) -> str:
    replaced = old if save_mode == "overwrite" else None
    entry = {"entry": drop_statement(replaced)} if replaced else {}
    if relocate:
        fresh = fresh_below(target)
        with write.scratch(spark, name, fresh, journal):
            pass
        journal.require_lease()
        journal.say("cleaning", beside=fresh, **entry)
        if replaced:
            drop_name(spark, replaced)
        delete_beside(spark, fresh)
        return fresh
    with landing(spark, target, replaced, in_place=save_mode == "none") as place:
        with write.scratch(spark, name, place.directory, journal):
            pass
        journal.require_lease()
        if not place.staged:
            journal.say("cleaning", **entry)
            if replaced:
                drop_name(spark, replaced)
            return target
        aside, replaces = aside_of(spark, target), exists(spark, target)
        if replaced and replaced.managed:
            # Its files go with it, so from here on there is no way back.
            journal.say("cleaning", move=[place.directory, target], directories=[aside], **entry)
            drop_name(spark, replaced)
            replaced = None
        else:
            journal.say("switching", swap={"target": target, "aside": aside, "replaces": replaces})
        with place.settled(aside):
            if journal.state == "switching":
                journal.say("cleaning", directories=[aside], **entry)
            if replaced:
                drop_name(spark, replaced)
    return target


def _empty(
    spark: SparkSession, write: Write, name: TableName, target: str, old: TableInfo | None, save_mode: str, journal: Journal
) -> None:
    if save_mode == "none" and not is_vacant(spark, target):
        # Spark would refuse a table with rows here, too.
        raise AlreadyExists(f"location {target} is not empty")
    aside = staging_beside(spark, target)
    try:
        with write.scratch(spark, name, aside, journal) as like:
            if save_mode != "overwrite":
                write.define_like(spark, name, like, target)
                return
            change = _Change(spark, journal, write, name, like, target, old, leftover=aside)
            with change.begun(exists(spark, target)):
                with swapped(spark, None, target, change.aside):
                    change.define_and_switch([])
    finally:
        delete_tree(spark, aside)


def _replace(spark: SparkSession, write: Write, name: TableName, target: str, old: TableInfo | None, journal: Journal) -> None:
    """Write first; then the new table is defined in full under another name and takes the old one's."""
    with landing(spark, target, old) as place:
        with write.scratch(spark, name, place.directory, journal) as scratch:
            change = _Change(spark, journal, write, name, scratch, target, old)
            if not place.staged:
                with change.begun(False):
                    change.switch(scratch)
                return
            specs = written_partitions(spark, scratch)
            with change.begun(exists(spark, target), place.directory):
                with place.settled(change.aside):
                    change.define_and_switch(specs)


def _relocate(
    spark: SparkSession, write: Write, name: TableName, target: str, old: TableInfo | None, journal: Journal
) -> str:
    """Write into a new directory, switch the name to it, then delete what was in ``target`` before."""
    fresh = fresh_below(target)
    try:
        with write.scratch(spark, name, fresh, journal) as scratch:
            change = _Change(spark, journal, write, name, scratch, fresh, old, beside=fresh)
            with change.begun(False):
                change.switch(scratch)
    except BaseException:
        delete_tree(spark, fresh)
        raise
    delete_beside(spark, fresh)
    return fresh


def written_partitions(spark: SparkSession, name: TableName) -> list[dict[str, str]]:
    """The partitions of the table that was written, as its catalog entry has them."""
    info = describe_table(spark, name)
    if not info.partition_columns:
        return []
    rows = list_partitions(spark, info).collect()
    return [{key: NULL_PARTITION if row[key] is None else row[key] for key in info.partition_columns} for row in rows]


class _Change:
    """The exchange of a table's entry, and of its directory, for those of a table that was written aside."""

    def __init__(
        self,
        spark: SparkSession,
        journal: Journal,
        write: Write,
        name: TableName,
        like: TableName,
        target: str,
        old: TableInfo | None,
        beside: str | None = None,
        leftover: str | None = None,
    ):
        self.spark, self.journal, self.write, self.name, self.like, self.target = spark, journal, write, name, like, target
        self.old, self.beside, self.leftover = old, beside, leftover
        self.before, self.ready, self.aside = name.sibling("replaced"), name.sibling("scratch"), aside_of(spark, target)
        self.replaces = False

    @contextmanager
    def begun(self, replaces: bool, staged: str | None = None):
        """What shall be done goes to the journal; a managed table, whose files go with its entry, is dropped."""
        self.replaces = replaces
        self.journal.require_lease()
        self.journal.say(
            "switching",
            table={
                "name": [self.name.database, self.name.table, self.name.catalog],
                "before": [self.name.database, self.before.table, self.name.catalog],
                "like": [self.name.database, self.like.table, self.name.catalog],
                "ready": self.ready.sql,
                "old": self.old is not None,
                "kind": "VIEW" if self.old and self.old.kind == "VIEW" else "TABLE",
                "managed": bool(self.old and self.old.managed),
                "target": self.target,
                "staged": staged,
                "aside": self.aside,
                "replaces": replaces,
                "properties": dict(self.write.properties),
            },
        )
        if self.old and self.old.managed:
            drop_name(self.spark, self.old)
            self.old = None
        yield

    def define_and_switch(self, specs: list[dict[str, str]]) -> None:
        """A table like the written one at ``target``, with its partitions, that takes the name once it is complete."""
        spark = self.spark
        try:
            self.write.define_like(spark, self.ready, self.like, self.target)
            if specs:
                info = describe_table(spark, self.ready)
                add_to_catalog(spark, info, specs, [default_location(info, spec) for spec in specs])
                held = len(every_location(spark, info))
                if held != len(specs):
                    raise StorageError(f"{held} of {len(specs)} partitions of {self.name} were registered")
            self.switch(self.ready)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {self.ready.sql}")

    def switch(self, ready: TableName) -> None:
        """Give the name to ``ready``. The old table keeps an entry until that is done."""
        spark, name, before = self.spark, self.name, self.before
        kind = "VIEW" if self.old and self.old.kind == "VIEW" else "TABLE"
        if self.old:
            spark.sql(f"ALTER {kind} {name.in_session} RENAME TO {before.in_session}")
        taken = False
        try:
            spark.sql(f"ALTER TABLE {ready.in_session} RENAME TO {name.in_session}")
            taken = True
            last = f"DROP {kind} IF EXISTS {before.in_session}"
            directories = ([self.aside] if self.replaces else []) + ([self.leftover] if self.leftover else [])
            self.journal.say("cleaning", entry=last, directories=directories, beside=self.beside)
            if self.old:
                spark.sql(last)
        except BaseException:
            self.journal.retract("cleaning")
            if taken:
                spark.sql(f"ALTER TABLE {name.in_session} RENAME TO {ready.in_session}")
            if self.old:
                spark.sql(f"ALTER {kind} {before.in_session} RENAME TO {name.in_session}")
            raise


class _Place:
    def __init__(self, spark: SparkSession, target: str, staged: bool):
        self._spark, self._target = spark, target
        self.staged = staged
        self.directory = staging_beside(spark, target) if staged else target

    @contextmanager
    def settled(self, aside: str | None = None):
        """A staged directory where it belongs, for good if the block ends well."""
        if self.staged:
            with swapped(self._spark, self.directory, self._target, aside):
                yield
        else:
            yield


@contextmanager
def landing(spark: SparkSession, target: str, replaced: TableInfo | None = None, in_place: bool = False):
    """Where a job writes what shall lie at ``target``.

    That is ``target`` itself while nothing is there, which spares the move;
    else a directory beside it, deleted if it was not settled. The directory of a
    table that is to be replaced never counts as free: dropping a managed table
    deletes it.
    """
    taken = replaced is not None and replaced.location is not None and same_place(spark, replaced.location, target)
    place = _Place(spark, target, not in_place and (taken or not is_vacant(spark, target)))
    try:
        yield place
    finally:
        if place.staged:
            delete_tree(spark, place.directory)
