"""Look at the first rows and the columns of a finished query run."""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DecimalType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from partloom.errors import ConfigError, NotFound
from partloom.sources.catalog import quote
from partloom.sources.storage import has_objects, normalise, shared_folder

_COLUMN = StructType(
    [
        StructField("case_sensitive", BooleanType()),
        StructField("catalog", StringType()),
        StructField("label", StringType()),
        StructField("name", StringType(), False),
        StructField("nullable", StringType()),
        StructField("precision", IntegerType()),
        StructField("scale", IntegerType()),
        StructField("database", StringType()),
        StructField("table", StringType()),
        StructField("type", StringType(), False),
    ]
)
# Where a row of a result stands, and how many files are opened by one job.
_FILE, _ROW, _MOST_FILES = "__file__", "__row__", 64
_PART = re.compile(r"part-(\d+)")


@dataclass(frozen=True)
class ColumnInfo:
    """A column of a result; facts that Spark does not keep are None."""

    name: str
    type: str
    label: str | None = None
    nullable: str | None = None
    precision: int | None = None
    scale: int | None = None
    case_sensitive: bool | None = None
    catalog: str | None = None
    database: str | None = None
    table: str | None = None


@dataclass(frozen=True)
class Preview:
    """At most ``max_rows`` rows of a run, every value as a string."""

    id: str
    columns: list[ColumnInfo]
    rows: list[list[str | None]]

    def columns_frame(self, spark: SparkSession) -> DataFrame:
        rows = [tuple(getattr(column, name) for name in _COLUMN.names) for column in self.columns]
        return spark.createDataFrame(rows, _COLUMN)

    def rows_frame(self, spark: SparkSession) -> DataFrame:
        schema = StructType([StructField(column.name, StringType()) for column in self.columns])
        return spark.createDataFrame([tuple(row) for row in self.rows], schema)


def view_of(run_id: str) -> str:
    return "query_run_" + run_id.replace("-", "_")


def result_folder(spark: SparkSession, run_id: str, output: str | None) -> str:
    """Where a run keeps its rows."""
    return normalise(output or shared_folder(spark) + "query-results") + run_id + "/"


def preview(spark: SparkSession, run_id: str, max_rows: int = 10, *, output: str | None = None) -> Preview:
    """The columns and the first ``max_rows`` (0 to 100) rows of a run.

    Runs of earlier sessions are found below ``output``, by default the folder
    that ``query`` writes to.
    """
    if not 0 <= max_rows <= 100:
        raise ConfigError(f"max_rows is {max_rows}, it must lie between 0 and 100")
    result = _result(spark, run_id, output)
    rows: list[list[str | None]] = []
    # The part numbers follow the order of the result; most often the first file is enough. Where it is
    # not, groups of files grow, so many small files take few jobs.
    paths, at, group = sorted(map(unquote, result.inputFiles()), key=_place), 0, 1
    while at < len(paths) and len(rows) < max_rows:
        chosen = paths[at : at + group]
        part = spark.read.schema(result.schema).parquet(*chosen).select(
            F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.row_index").alias(_ROW), *_as_strings(result.schema)
        )
        # A file gives no more rows than are wanted in all.
        few = part.where(F.col(_ROW) < max_rows - len(rows)).collect()
        place = {path.rsplit("/", 1)[-1]: i for i, path in enumerate(chosen)}
        few.sort(key=lambda row: (place[unquote(row[_FILE])], row[_ROW]))
        rows += [list(row)[2:] for row in few[: max_rows - len(rows)]]
        at, group = at + group, min(group * 4, _MOST_FILES)
    return Preview(run_id, [_describe(f) for f in result.schema.fields], rows)


def _result(spark: SparkSession, run_id: str, output: str | None) -> DataFrame:
    if spark.catalog.tableExists(view_of(run_id)):
        return spark.table(view_of(run_id))
    folder = result_folder(spark, run_id, output)
    if not has_objects(spark, folder):
        raise NotFound(f"there is no result of a query run {run_id}")
    return spark.read.parquet(folder)


def _place(path: str) -> tuple[int, str]:
    """Where a file stands in the result: by task, then by its number within the task."""
    name = path.rsplit("/", 1)[-1]
    return int(_PART.search(name).group(1)), name


def _as_strings(schema: StructType) -> list[Column]:
    return [_as_string(F.col(quote(f.name)), f).alias(f.name) for f in schema.fields]


def _as_string(value: Column, field: StructField) -> Column:
    if isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
        return F.to_json(value)
    if isinstance(field.dataType, BinaryType):
        return F.hex(value)
    return value.cast("string")


def _describe(field: StructField) -> ColumnInfo:
    decimal = field.dataType if isinstance(field.dataType, DecimalType) else None
    return ColumnInfo(
        name=field.name,
        label=field.name,
        type=field.dataType.simpleString(),
        nullable="NULLABLE" if field.nullable else "NOT_NULL",
        precision=decimal.precision if decimal else None,
        scale=decimal.scale if decimal else None,
    )
