"""SQL text: given inline, in a local file or at a URI, with ``${name}`` variables."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from partloom.errors import ConfigError
from partloom.sources.access import note_access
from partloom.sources.catalog import quote
from partloom.sources.storage import only_file

_VARIABLE = re.compile(r"\$\{\s*([^{}]+?)\s*\}")
_URI = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://\S+")
_LOCAL_FILE = re.compile(r"\S+\.sql")


def load_sql(spark: SparkSession, command: str | os.PathLike, params: Mapping | None = None) -> str:
    """The text of ``command`` with its variables filled in.

    A path object, a word ending in ``.sql`` and the URI of one file are read; all else is SQL.
    """
    if isinstance(command, os.PathLike):
        text = Path(command).read_text(encoding="utf-8")
    elif _URI.fullmatch(command.strip()):
        text = _at_uri(spark, command.strip())
    elif _LOCAL_FILE.fullmatch(command.strip()):
        text = Path(command.strip()).read_text(encoding="utf-8")
    else:
        text = command
    return re.sub(r";\s*$", "", fill(text, params or {}))


def _at_uri(spark: SparkSession, uri: str) -> str:
    row = spark.read.text(only_file(spark, uri), wholetext=True).first()
    if row is None or not row[0].strip():
        raise ConfigError(f"{uri} holds no SQL")
    return row[0]


def fill(text: str, params: Mapping) -> str:
    """Replace each ``${name}``; ``${a.b}`` looks inside nested mappings."""

    def value(match: re.Match) -> str:
        found = params
        for part in match.group(1).split("."):
            if not isinstance(found, Mapping) or part not in found:
                raise ConfigError(f"no value for the variable {match.group(0)}")
            found = found[part]
        return str(found)

    return _VARIABLE.sub(value, text)


def session_in(spark: SparkSession, database: str | None, catalog: str | None = None) -> SparkSession:
    """A session that resolves unqualified names against ``database``.

    ``USE`` holds for every thread of a session, so another current database gets a copy of the
    session: same settings, views and functions as now, but what a statement adds or sets stays there.
    """
    if database is None:
        return spark
    current = (spark.catalog.currentCatalog(), spark.catalog.currentDatabase())
    if (catalog or current[0], database) == current:
        return spark
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.sql("USE " + ".".join(quote(p) for p in (catalog, database) if p))
    return own


def select_frame(
    spark: SparkSession,
    command: str | os.PathLike,
    *,
    params: Mapping | None = None,
    args: Mapping | list | None = None,
    database: str | None = None,
    catalog: str | None = None,
) -> DataFrame:
    """The analysed, not yet executed, DataFrame of a SELECT."""
    text = load_sql(spark, command, params)
    return note_access(session_in(spark, database, catalog).sql(text, args=args))
