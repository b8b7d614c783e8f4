"""Add a partition as select: store the rows of a SELECT as one partition of a table."""

from __future__ import annotations

import logging
import os
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from partloom.errors import AlreadyExists, ConfigError
from partloom.operators.ctas import Layout, Write, choose, landing, read_files, written_partitions
from partloom.operators.partitions import SAVE_MODES, outcome, refuse_managed, refuse_shared, refuse_table_root
from partloom.operators.schema_diff import differences, report
from partloom.plans.journal import Journal, writing
from partloom.plans.layout import for_table, rebalance as rebalance_rows
from partloom.plans.limits import TEN_MINUTES, time_limit
from partloom.sources.catalog import (
    Spec,
    TableInfo,
    TableName,
    add_to_catalog,
    data_columns,
    default_location,
    drop_from_catalog,
    has_spec,
    key_types,
    move_in_catalog,
    order_specs,
    partition_locations,
    partitioned_table,
    present,
    quote,
)
from partloom.sources.formats import PROVIDERS, Storage, storage_of
from partloom.sources.places import note
from partloom.sources.sqltext import select_frame
from partloom.sources.storage import (
    Swap,
    aside_of,
    delete_tree,
    exists,
    for_each,
    fresh_below,
    has_objects,
    normalise,
    parent_of,
    same_place,
    staging_beside,
)

log = logging.getLogger(__name__)


def apas(
    spark: SparkSession,
    select: str | os.PathLike,
    *,
    database: str,
    table: str,
    partition_kv: Spec,
    location: str | None = None,
    format: str | None = None,
    compression: str | None = None,
    field_delimiter: str | None = None,
    save_mode: str = "overwrite",
    bucketed_by: Sequence[str] = (),
    bucket_count: int | None = None,
    additional_properties: Mapping[str, str] | None = None,
    ignore_schema_diff: bool = False,
    rebalance: bool | None = None,
    relocate: bool = False,
    params: Mapping | None = None,
    args: Mapping | list | None = None,
    timeout: timedelta | None = TEN_MINUTES,
    catalog: str | None = None,
) -> DataFrame:
    """Store the rows of ``select``, which has the data columns only, as one partition.

    One row comes back: the keys, the ``location`` and the ``action``, which is
    ``stored``, ``kept`` (skipped) or ``empty`` (no rows, hence no partition).
    The schema is compared before anything is written, and the old partition goes
    only when the new rows are complete. Format, compression and delimiter are
    those of the table unless given. A table made with buckets gets its rows in those, so that joins on them
    need no shuffle. In any other one ``bucketed_by`` divides the files, but the
    catalog does not know the partition as bucketed. ``rebalance`` shuffles the
    rows into files of even size; by default that is done for buckets and for
    text files with strings, each of which one task must read.
    ``additional_properties`` are options of the files' writer.

    ``relocate`` never moves files: the rows go to a new directory beside the partition's place, the
    catalog is pointed to it in one call, and the old directory is deleted last. The time limit
    covers the job that writes.
    """
    choose("save_mode", save_mode, SAVE_MODES)
    layout = Layout((), bucketed_by, bucket_count)
    info = partitioned_table(spark, TableName(database, table, catalog))
    layout = _buckets_of(info, layout)
    spec = order_specs(spark, info, [partition_kv])[0]
    home = default_location(info, spec)
    target = normalise(location) if location else home
    refuse_table_root(spark, info, [target])

    def done(action: str, place: str = target) -> DataFrame:
        return outcome(spark, info.partition_columns, [spec], [place], [action])

    # The lease on the place that the keys name stands for the catalog entry, wherever the files go.
    with writing(spark, [target, home], within=info.location, what=f"the partition {spec} of {info.name}") as journal:
        held = present(spark, info, [spec])[0]
        if save_mode != "overwrite" and (held or has_objects(spark, target)):
            what = f"the partition {spec} of {info.name}" if held else f"objects in {target}"
            if save_mode == "error_if_exists":
                raise AlreadyExists(f"{what} already exist" + ("s" if held else ""))
            log.info("%s: there already, nothing done", what)
            return done("kept")

        frame = select_frame(spark, select, params=params, args=args, database=database, catalog=catalog)
        columns = data_columns(spark, info)
        report(differences(columns, frame.schema), str(info.name), "the SELECT", not ignore_schema_diff)

        storage = _storage(info, format, compression, field_delimiter)
        rows = _like_table(frame, columns, positional=storage.provider == "csv")
        if rebalance is not False:
            spread = for_table(rows, (), layout.bucketed_by, layout.bucket_count)
            even = spread is rows and (rebalance or storage.unsplittable)
            rows = rebalance_rows(rows) if even else spread
        storage = replace(storage, options={**storage.options, **(additional_properties or {})})
        write = Write(rows, storage, layout, timeout=timeout)
        old_place = partition_locations(spark, info, [spec])[0] if held else None
        refuse_shared(spark, info, [spec], [target])

        if relocate:
            stored = _relocate(spark, info, spec, write, target, old_place, journal)
        else:
            stored = _swap(spark, info, spec, write, target, old_place, journal)
        spark.catalog.refreshTable(info.name.sql)
        return done("stored", stored) if stored else done("empty")


def _buckets_of(info: TableInfo, layout: Layout) -> Layout:
    """The layout in the buckets of the table, if it has some: readers take them for granted."""
    if not info.bucket_columns:
        return layout
    asked = (tuple(name.lower() for name in layout.bucketed_by), layout.bucket_count)
    if layout.bucketed_by and asked != (tuple(name.lower() for name in info.bucket_columns), info.bucket_count):
        raise ConfigError(f"{info.name} has {info.bucket_count} buckets by {list(info.bucket_columns)}, its partitions can have no others")
    return Layout(layout.partitioned_by, info.bucket_columns, info.bucket_count, info.sort_columns)


def _note(info: TableInfo, items: list[dict]) -> dict:
    return {"name": [info.name.database, info.name.table, info.name.catalog], "partitions": items}


def _register(spark: SparkSession, info: TableInfo, spec: Spec, old_place: str | None, place: str) -> None:
    note(spark, info, [spec], [place])
    if old_place is None:
        add_to_catalog(spark, info, [spec], [place])
    elif not same_place(spark, old_place, place):
        move_in_catalog(spark, info, spec, place)


def _swap(
    spark: SparkSession, info: TableInfo, spec: Spec, write: Write, target: str, old_place: str | None, journal: Journal
) -> str | None:
    """Write beside ``target``, or into it while it is vacant, and bring the two in line. None without rows."""
    held = old_place is not None
    with landing(spark, target) as place:
        with write.scratch(spark, info.name, place.directory, journal):
            pass
        # A SELECT without rows still leaves a file, so look inside.
        empty = _is_empty(spark, write, place.directory)
        journal.require_lease()
        if empty:
            refuse_managed(info, held)
            facts = _note(info, [])
            journal.say("cleaning", name=facts["name"], drop=[spec] if held else [], directories=[target], staged_too=True)
            if held:
                drop_from_catalog(spark, info, [spec])
            delete_tree(spark, target)
            return None
        aside, replaces = aside_of(spark, target), place.staged and exists(spark, target)
        item = {"spec": spec, "held": held, "old_place": old_place, "target": target, "replaces": replaces}
        journal.say("switching", **_note(info, [{**item, "aside": aside if place.staged else None}]))
        with place.settled(aside):
            _register(spark, info, spec, old_place, target)
            journal.say("cleaning", directories=[aside])
    return target


def _is_empty(spark: SparkSession, write: Write, directory: str) -> bool:
    with time_limit(spark, write.timeout):
        return read_files(spark, directory, write.storage, write.rows).isEmpty()


def _relocate(
    spark: SparkSession, info: TableInfo, spec: Spec, write: Write, target: str, old_place: str | None, journal: Journal
) -> str | None:
    """Write into a new directory beside ``target``, register it, then delete the old one. None without rows."""
    fresh = fresh_below(parent_of(spark, target))
    if old_place:
        refuse_table_root(spark, info, [old_place])
        refuse_shared(spark, info, [spec], [old_place])
    old_places = [place for place in (old_place, target) if place]
    try:
        with write.scratch(spark, info.name, fresh, journal):
            pass
        empty = _is_empty(spark, write, fresh)
        journal.require_lease()
        if not empty:
            item = {"spec": spec, "held": old_place is not None, "old_place": old_place, "target": fresh, "replaces": False}
            journal.say("switching", **_note(info, [item]))
            _register(spark, info, spec, old_place, fresh)
            journal.say("cleaning", directories=old_places)
    except BaseException:
        delete_tree(spark, fresh)
        raise
    if empty:
        refuse_managed(info, old_place is not None)
        facts = _note(info, [])
        journal.say("cleaning", name=facts["name"], drop=[spec] if old_place else [], directories=old_places, staged_too=True)
        delete_tree(spark, fresh)
        if old_place:
            drop_from_catalog(spark, info, [spec])
    for place in old_places:
        delete_tree(spark, place)
    return None if empty else fresh


# --- many partitions ---------------------------------------------------------


def apas_many(
    spark: SparkSession,
    select: str | os.PathLike,
    *,
    database: str,
    table: str,
    expected: Sequence[Spec] = (),
    format: str | None = None,
    compression: str | None = None,
    field_delimiter: str | None = None,
    save_mode: str = "overwrite",
    additional_properties: Mapping[str, str] | None = None,
    ignore_schema_diff: bool = False,
    rebalance: bool | None = None,
    relocate: bool = False,
    params: Mapping | None = None,
    args: Mapping | list | None = None,
    timeout: timedelta | None = TEN_MINUTES,
    catalog: str | None = None,
) -> DataFrame:
    """Store the rows of ``select``, which has the key columns as well, as one partition per combination of keys.

    One row per partition comes back: the keys, the ``location``, and the ``action``: ``stored``, or ``kept``
    where ``skip_if_exists`` leaves what is there. The SELECT runs once, in one job that writes all
    partitions aside, however many there are; rows of one key are brought together unless
    ``rebalance=False``. Partitions that it has no rows for stay as they are, but those named in ``expected``
    are dropped with their files (``empty``), as ``apas`` does.

    The partitions change together: after a failure all are as before, and a dead driver's call is
    taken to all old or all new by ``recover``. With ``relocate`` the written files stay in a new directory of
    the table and only the catalog changes, which is the way for object stores; otherwise each partition's
    directory takes its place by a rename. ``error_if_exists`` looks at the partitions that have rows, before
    any of them changes. The table's lease is held as a whole.
    """
    choose("save_mode", save_mode, SAVE_MODES)
    info = partitioned_table(spark, TableName(database, table, catalog))
    keys = list(info.partition_columns)
    wanted = order_specs(spark, info, list(expected)) if expected else []
    with writing(spark, [info.location], what=f"the table {info.name}") as journal:
        frame = select_frame(spark, select, params=params, args=args, database=database, catalog=catalog)
        given = {name.lower(): name for name in frame.columns}
        if missing := [key for key in keys if key.lower() not in given]:
            raise ConfigError(f"the SELECT lacks the partition keys {missing} of {info.name}")
        of_keys = {given[key.lower()] for key in keys}
        columns = data_columns(spark, info)
        data = frame.select(*(F.col(quote(name)) for name in frame.columns if name not in of_keys))
        report(differences(columns, data.schema), str(info.name), "the SELECT", not ignore_schema_diff)

        storage = _storage(info, format, compression, field_delimiter)
        types = key_types(spark, info)
        placed = [F.col(quote(given[key.lower()])).cast(types[key]).alias(key) for key in keys]
        rows = _like_table(frame, columns, positional=storage.provider == "csv", keep=placed, without=of_keys)
        if rebalance is not False:
            rows = for_table(rows, keys, (), None)
        storage = replace(storage, options={**storage.options, **(additional_properties or {})})
        write = Write(rows, storage, _buckets_of(info, Layout(keys)), timeout=timeout)
        place = fresh_below(info.location) if relocate else staging_beside(spark, info.location)
        try:
            with write.scratch(spark, info.name, place, journal) as scratch:
                specs = written_partitions(spark, scratch)
            return _exchange(spark, info, journal, specs, wanted, place, save_mode, relocate)
        finally:
            if not relocate:
                delete_tree(spark, place)


@dataclass(frozen=True)
class _Part:
    """One partition of a change of many: where its new files lie, where they go, and what was there."""

    spec: dict[str, str]
    written: str
    target: str
    old_place: str | None


def _exchange(
    spark: SparkSession,
    info: TableInfo,
    journal: Journal,
    specs: list[dict[str, str]],
    wanted: list[dict[str, str]],
    place: str,
    save_mode: str,
    relocate: bool,
) -> DataFrame:
    """Bring the written partitions, and the absence of wanted ones without rows, into the table at once."""
    try:
        gone = [spec for spec in wanted if spec not in specs]
        places = _old_places(spark, info, [*specs, *gone])
        new, without = places[: len(specs)], places[len(specs):]
        homes = [default_location(info, spec) for spec in specs]
        taken = [old is not None or full for old, full in zip(new, for_each(spark, lambda home: has_objects(spark, home), homes))]
        if save_mode == "error_if_exists" and any(taken):
            raise AlreadyExists(f"{info.name} already has the partitions {[s for s, t in zip(specs, taken) if t]}")
        keep = [save_mode == "skip_if_exists" and there for there in taken]
        if save_mode != "overwrite":
            gone, without = [], []
        refuse_managed(info, any(old is not None for old in without))
        parts = [
            _Part(spec, _inside(info, place, spec), _inside(info, place, spec) if relocate else home, old)
            for spec, home, old, kept in zip(specs, homes, new, keep)
            if not kept
        ]
        leaving = [(spec, old) for spec, old in zip(gone, without) if old is not None]
        own = [part.spec for part in parts] + [spec for spec, _ in leaving]
        deleted = [old for _, old in leaving]
        deleted += [p for part in parts if relocate for p in {part.old_place, default_location(info, part.spec)} if p]
        touched = [part.target for part in parts if not relocate] + deleted
        refuse_table_root(spark, info, touched)
        refuse_shared(spark, info, own, touched)
        journal.require_lease()
        _commit(spark, info, journal, parts, leaving, deleted, relocate)
    except BaseException:
        if journal.state != "cleaning":  # else the partitions lie in there
            delete_tree(spark, place)
        raise
    for spec, kept in zip(specs, keep):
        if kept and relocate:
            delete_tree(spark, _inside(info, place, spec))
    spark.catalog.refreshTable(info.name.sql)
    moved = {tuple(part.spec.values()): part.target for part in parts}
    every = [*specs, *gone]
    at = [moved.get(tuple(spec.values())) or old or default_location(info, spec) for spec, old in zip(every, [*new, *without])]
    actions = ["kept" if kept else "stored" for kept in keep] + ["empty"] * len(gone)
    return outcome(spark, info.partition_columns, every, at, actions)


def _inside(info: TableInfo, place: str, spec: Spec) -> str:
    return normalise(place) + default_location(info, spec)[len(normalise(info.location)):]


def _old_places(spark: SparkSession, info: TableInfo, specs: list[dict[str, str]]) -> list[str | None]:
    held = present(spark, info, specs)
    found = iter(partition_locations(spark, info, [spec for spec, is_held in zip(specs, held) if is_held]))
    return [next(found) if is_held else None for is_held in held]


def _commit(
    spark: SparkSession,
    info: TableInfo,
    journal: Journal,
    parts: list[_Part],
    leaving: list[tuple[dict[str, str], str]],
    deleted: list[str],
    relocate: bool,
) -> None:
    """All of the changes or none: what was done is undone in reverse where a step fails."""
    asides = [None if relocate else aside_of(spark, part.target) for part in parts]
    replaces = [not relocate and there for there in for_each(spark, lambda part: exists(spark, part.target), parts)]
    items = [
        {"spec": part.spec, "held": part.old_place is not None, "old_place": part.old_place, "target": part.target,
         "aside": aside, "replaces": there}
        for part, aside, there in zip(parts, asides, replaces)
    ] + [{"spec": spec, "held": True, "old_place": old, "target": old, "replaces": True} for spec, old in leaving]
    journal.say("switching", **_note(info, items))
    added = [part for part in parts if part.old_place is None]
    moved = [part for part in parts if part.old_place is not None and not same_place(spark, part.old_place, part.target)]
    swaps = [] if relocate else [Swap(spark, part.written, part.target, aside) for part, aside in zip(parts, asides)]
    placed: list[Swap] = []

    def place(swap: Swap) -> None:
        swap.place()
        placed.append(swap)

    entries = False
    try:
        for_each(spark, place, swaps)
        entries = True
        add_to_catalog(spark, info, [part.spec for part in added], [part.target for part in added])
        for_each(spark, lambda part: move_in_catalog(spark, info, part.spec, part.target), moved)
        drop_from_catalog(spark, info, [spec for spec, _ in leaving])
        asides = [aside for aside in asides if aside]
        journal.say("cleaning", directories=[*deleted, *asides], staged_too=not relocate)
    except BaseException:
        if entries:
            _entries_back(spark, info, added, moved, leaving)
        for_each(spark, Swap.undo, placed)
        raise
    for_each(spark, Swap.finish, swaps)
    for_each(spark, lambda place: delete_tree(spark, place), deleted)


def _entries_back(
    spark: SparkSession, info: TableInfo, added: list[_Part], moved: list[_Part], leaving: list[tuple[dict[str, str], str]]
) -> None:
    drop_from_catalog(spark, info, [part.spec for part in added if has_spec(spark, info.name, part.spec)])
    for_each(spark, lambda part: move_in_catalog(spark, info, part.spec, part.old_place), moved)
    for spec, old in leaving:
        if not has_spec(spark, info.name, spec):
            add_to_catalog(spark, info, [spec], [old])


def _storage(info: TableInfo, format: str | None, compression: str | None, delimiter: str | None) -> Storage:
    """The table's own storage with the given options put over it."""
    storage = storage_of(info)
    if format is not None and PROVIDERS.get(format) != storage.provider:
        raise ConfigError(f"{info.name} is stored as {storage.provider}, it could not read '{format}' files")
    options = dict(storage.options)
    if compression and storage.provider in ("parquet", "orc"):
        options["compression"] = compression
    if delimiter and storage.provider == "csv":
        options["sep"] = delimiter
    log.info("%s: writing %s with %s", info.name, storage.provider, options)
    return replace(storage, options=options)


def _like_table(
    frame: DataFrame, columns: StructType, positional: bool, keep: Sequence[Column] = (), without: Collection[str] = ()
) -> DataFrame:
    """Columns in the table's order and spelling; those it does not know come last.

    In text files a value's column is its position, so there a column that the
    SELECT lacks is filled with nulls. ``keep`` are columns that come after all, in place of those in ``without``.
    """
    given = {name.lower(): name for name in frame.columns if name not in without}
    known = {f.name.lower() for f in columns.fields}
    selected = []
    for f in columns.fields:
        if f.name.lower() in given:
            selected.append(F.col(quote(given[f.name.lower()])).alias(f.name))
        elif positional:
            selected.append(F.lit(None).cast(f.dataType).alias(f.name))
    selected += [F.col(quote(name)) for key, name in given.items() if key not in known]
    return frame.select(*selected, *keep)
