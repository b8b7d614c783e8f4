"""Where the partitions of a table lie that are not where their keys say: an index asked before a directory goes.

A partition in its own place (``<table>/<key>=<value>/…``, or the new directory that a relocation made
there) shares a directory with no other, by its name alone. All others are noted in a tree of directories beside the
table, one level per level of their path, so that those above, at or below a directory are found with a few
look-ups, however many partitions the table has. A note is written before the catalog learns of the place and
is checked against the catalog when it is met, so a stale one costs a look and nothing else.

The tree begins with one listing of the catalog, the first time that it is asked for, and counts for that
table entry only: where the table was made anew it is listed again. Places that other tools register later are
not in it; ``forget`` makes the next call list the catalog anew.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence

from pyspark.sql import SparkSession

from partloom.sources.catalog import (
    Spec,
    TableInfo,
    default_location,
    escape_value,
    every_location,
    has_spec,
    location_of,
    spec_of,
)
from partloom.sources.storage import (
    create_new,
    delete_tree,
    for_each,
    full_name,
    names_in,
    overlapping,
    parent_of,
    read_text,
)

# The directory that holds the notes on exactly one place; below the same parent lie deeper places.
_HERE = "+"


def _root(spark: SparkSession, info: TableInfo) -> str:
    place = full_name(spark, info.location)
    return f"{parent_of(spark, place)}_places.{hashlib.sha1(place.encode()).hexdigest()[:20]}/"


def _identity(info: TableInfo) -> str:
    return f"{info.name} {info.created_at}"


def _levels(place: str) -> list[str]:
    return ["d" + escape_value(part) for part in place.split("/") if part]


def at_home(spark: SparkSession, info: TableInfo, spec: Spec, place: str) -> bool:
    """Whether the partition lies in its own place, or in a directory that a relocation made beside it."""
    own, place = full_name(spark, default_location(info, spec)), full_name(spark, place)
    if place == own:
        return True
    table = full_name(spark, info.location)
    beside = re.escape(own[: own.rstrip("/").rindex("/") + 1]) + r"_run=[0-9a-f]{32}/"
    together = re.escape(table) + r"_run=[0-9a-f]{32}/" + re.escape(own[len(table):])
    return re.fullmatch(f"{beside}|{together}", place) is not None


def note(spark: SparkSession, info: TableInfo, specs: Sequence[Spec], places: Sequence[str]) -> None:
    """Put places that no key tells into the index; to be called before the catalog learns of them."""
    away = [(spec, place) for spec, place in zip(specs, places) if not at_home(spark, info, spec, place)]
    if away:
        root = _root(spark, info)
        for_each(spark, lambda pair: _write(spark, root, *pair), away)


def _write(spark: SparkSession, root: str, spec: Spec, place: str) -> None:
    text = json.dumps({"spec": dict(spec), "place": place})
    name = hashlib.sha1(text.encode()).hexdigest()[:20]
    create_new(spark, "/".join([root.rstrip("/"), *_levels(full_name(spark, place)), _HERE, name]), text)


def forget(spark: SparkSession, info: TableInfo) -> None:
    """Let the next look list the catalog anew."""
    delete_tree(spark, _root(spark, info))


def others_at(spark: SparkSession, info: TableInfo, specs: Sequence[Spec], places: Sequence[str]) -> list[str]:
    """Which of ``places`` hold, or lie within, the directory of a partition that is none of ``specs``."""
    if info.name.catalog not in (None, "spark_catalog") or not places:
        return []
    if not all(_told_by_name(spark, info, specs, place) for place in places):
        return _listed(spark, info, specs, places)
    root = _root(spark, info)
    if read_text(spark, f"{root}complete") != _identity(info):
        _begin(spark, info, root)
    return [place for place, shared in zip(places, for_each(spark, lambda p: _met(spark, info, root, specs, p), places)) if shared]


def _told_by_name(spark: SparkSession, info: TableInfo, specs: Sequence[Spec], place: str) -> bool:
    """Whether no partition in a place of its own can be there: outside the table, or the own place of one of ``specs``."""
    inside = full_name(spark, place).startswith(full_name(spark, info.location))
    return not inside or any(at_home(spark, info, spec, place) for spec in specs)


def _listed(spark: SparkSession, info: TableInfo, specs: Sequence[Spec], places: Sequence[str]) -> list[str]:
    own = {tuple(spec.values()) for spec in specs}
    others = [place for spec, place in every_location(spark, info) if tuple(spec.values()) not in own]
    return overlapping(spark, places, others)


def _begin(spark: SparkSession, info: TableInfo, root: str) -> None:
    found = every_location(spark, info)
    note(spark, info, [spec for spec, _ in found], [place for _, place in found])
    delete_tree(spark, f"{root}complete")
    create_new(spark, f"{root}complete", _identity(info))


def _met(spark: SparkSession, info: TableInfo, root: str, specs: Sequence[Spec], place: str) -> bool:
    """Whether a noted partition, which is none of ``specs``, lies above, at or below ``place``."""
    own = {tuple(spec.values()) for spec in specs}
    levels = _levels(full_name(spark, place))
    above = [root.rstrip("/") + "".join(f"/{level}" for level in levels[:depth]) for depth in range(1, len(levels))]
    todo = [f"{folder}/{_HERE}" for folder in above] + [root.rstrip("/") + "".join(f"/{level}" for level in levels)]
    while todo:
        folder = todo.pop()
        if not folder.endswith(f"/{_HERE}"):
            todo += [f"{folder}/{name}" for name in names_in(spark, folder)]
            continue
        for name in names_in(spark, folder):
            if _stands(spark, info, own, f"{folder}/{name}"):
                return True
    return False


def _stands(spark: SparkSession, info: TableInfo, own: set[tuple], file: str) -> bool:
    """Whether the note on another partition still holds; one that does not is taken away."""
    try:
        told = json.loads(read_text(spark, file) or "")
    except ValueError:  # being written, for a partition that is not in the catalog yet
        return False
    spec = spec_of(info, told["spec"])
    if spec is not None and tuple(spec.values()) in own:
        return False
    if spec is not None and has_spec(spark, info.name, spec):
        if full_name(spark, location_of(spark, info.name, spec)) == full_name(spark, told["place"]):
            return True
    delete_tree(spark, file)
    return False
