"""Compare the columns of two tables, or of a table and a SELECT."""

from __future__ import annotations

import logging
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from partloom.errors import SchemaMismatch
from partloom.sources.catalog import TableName, data_columns, describe_table

log = logging.getLogger(__name__)


def diff_schema(
    spark: SparkSession,
    *,
    database: str,
    original: str,
    comparison: str,
    error_if_diff_found: bool = True,
    catalog: str | None = None,
) -> DataFrame:
    """Columns of both tables by name and type: ``column, original_type, comparison_type, side``.

    ``side`` is ``both``, ``left_only`` (original) or ``right_only`` (comparison);
    a column whose type differs shows up once on each side. Order and comments do
    not matter, nor do the partition keys of the original.
    """
    left = data_columns(spark, describe_table(spark, TableName(database, original, catalog)))
    right = spark.table(TableName(database, comparison, catalog).sql).schema
    report(differences(left, right), f"{database}.{original}", f"{database}.{comparison}", error_if_diff_found)
    return (
        _columns(spark, left, "original_type")
        .join(_columns(spark, right, "comparison_type"), ["column", "type"], "full_outer")
        .select(
            "column",
            "original_type",
            "comparison_type",
            F.when(F.col("comparison_type").isNull(), "left_only")
            .when(F.col("original_type").isNull(), "right_only")
            .otherwise("both")
            .alias("side"),
        )
    )


def differences(original: StructType, comparison: StructType) -> tuple[list[str], list[str]]:
    """``name: type`` of the columns found in one schema only."""
    left, right = _named(original), _named(comparison)
    return _without(left, right), _without(right, left)


def report(found: tuple[list[str], list[str]], original: str, comparison: str, error: bool) -> None:
    """Raise on a difference, or else log it."""
    texts = [
        f"{', '.join(columns)} in {here} but not in {there}"
        for columns, here, there in ((found[0], original, comparison), (found[1], comparison, original))
        if columns
    ]
    if texts and error:
        raise SchemaMismatch("; ".join(texts))
    for text in texts:
        log.warning(text)


def _named(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def _without(left: Iterable[tuple[str, str]], right: Iterable[tuple[str, str]]) -> list[str]:
    rest = list(right)
    only = []
    for column in left:
        if column in rest:
            rest.remove(column)
        else:
            only.append(f"{column[0]}: {column[1]}")
    return only


def _columns(spark: SparkSession, schema: StructType, label: str) -> DataFrame:
    pairs = _named(schema)
    columns = {
        "column": pa.array([name for name, _ in pairs], pa.string()),
        "type": pa.array([kind for _, kind in pairs], pa.string()),
    }
    return spark.createDataFrame(pa.table(columns)).withColumn(label, F.col("type"))
