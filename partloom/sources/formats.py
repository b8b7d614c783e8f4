"""File formats a table can be stored in, and the options that keep values whole."""

from __future__ import annotations

import logging
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, CharType, DataType, MapType, StringType, StructType, VarcharType

from partloom.errors import ConfigError
from partloom.sources.catalog import TableInfo

log = logging.getLogger(__name__)

# Format names and the Spark data source behind each.
PROVIDERS = {
    "parquet": "parquet",
    "orc": "orc",
    "avro": "avro",
    "json": "json",
    "textfile": "csv",
}

# SerDe libraries and the format each reads; any other is textfile.
SERDE_FORMATS = {
    "org.apache.hadoop.hive.ql.io.parquet.serde.ParquetHiveSerDe": "parquet",
    "org.apache.hadoop.hive.ql.io.orc.OrcSerde": "orc",
    "org.apache.hadoop.hive.serde2.avro.AvroSerDe": "avro",
    "org.apache.hadoop.hive.serde2.lazy.LazySimpleSerDe": "textfile",
    "org.apache.hadoop.hive.serde2.OpenCSVSerde": "textfile",
    "org.apache.hive.hcatalog.data.JsonSerDe": "json",
    "org.openx.data.jsonserde.JsonSerDe": "json",
    "com.amazon.emr.hive.serde.CloudTrailSerde": "json",
    "com.amazonaws.glue.serde.GrokSerDe": "textfile",
    "org.apache.hadoop.hive.serde2.RegexSerDe": "textfile",
}

# Spark's own default cuts times to milliseconds in text formats.
_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Needed on the writing side, whatever the table says, to keep blanks and null map values.
_CSV_WRITE = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_JSON_WRITE = {"ignoreNullFields": "false"}


@dataclass(frozen=True)
class Storage:
    """A Spark data source and its options, as CREATE TABLE takes them."""

    provider: str
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def unsplittable(self) -> bool:
        """Whether a file, however large, is read by one task."""
        return self.options.get("multiLine", "").lower() == "true"

    @property
    def line_end(self) -> str | None:
        """What ends a line of text and so must be in no value; None where a value may span lines, or nothing is told."""
        return self.options.get("lineSep") if self.provider == "csv" and not self.unsplittable else None


# Ends of lines to be tried in turn: the usual one, and a character that texts hardly ever hold.
_LINE_ENDS = ("\n", "\u001e")

# Said by a write whose values hold the end of its lines.
_HOLDS_LINE_END = "a value holds the end of lines"


def splittable(storage: Storage) -> list[Storage]:
    """Ways to store text in files that many tasks can share, the sure way last.

    Where no value holds the end of lines, a line is a row and files are read in parts. Whether that is so
    shows while the rows are written.
    """
    if not storage.unsplittable:
        return [storage]
    options = {k: v for k, v in storage.options.items() if k != "multiLine"}
    return [Storage(storage.provider, {**options, "lineSep": end}) for end in _LINE_ENDS] + [storage]


def in_lines(rows: DataFrame, storage: Storage, keys: Collection[str] = ()) -> DataFrame:
    """The rows, which fail as soon as a value that goes into the files holds the end of a line."""
    end = storage.line_end
    if end is None:
        return rows
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, StringType) and f.name not in keys]
    of = lambda name: rows["`" + name.replace("`", "``") + "`"]
    checked = {name: F.when(F.contains(of(name), F.lit(end)), F.raise_error(F.lit(_HOLDS_LINE_END))).otherwise(of(name)) for name in texts}
    return rows.withColumns(checked) if checked else rows


def holds_line_end(error: BaseException) -> bool:
    """Whether a write failed for that."""
    return _HOLDS_LINE_END in str(error)


def storage_for(
    format: str, schema: StructType, compression: str | None = None, field_delimiter: str | None = None
) -> Storage:
    """How a new table is stored. Compression is for parquet and orc, the delimiter for textfile."""
    if format not in PROVIDERS:
        raise ConfigError(f"format '{format}' is not supported, use one of {sorted(PROVIDERS)}")
    provider = PROVIDERS[format]
    options: dict[str, str] = {}
    if provider not in ("parquet", "orc"):
        log.info("compression does not apply to the format %s", format)
    elif compression:
        options["compression"] = compression
    if provider == "json":
        options |= _TIMES | _JSON_WRITE
    elif provider == "csv":
        options |= _TIMES | _CSV_WRITE
        options |= {"sep": field_delimiter or "\u0001", "nullValue": "\\N", "lineSep": "\n"}
        if _holds_text(schema):
            # A text may contain line ends; its row then spans several lines.
            options["multiLine"] = "true"
    return Storage(provider, options)


def _holds_text(schema: StructType) -> bool:
    def text(kind: DataType) -> bool:
        if isinstance(kind, ArrayType):
            return text(kind.elementType)
        if isinstance(kind, MapType):
            return text(kind.keyType) or text(kind.valueType)
        if isinstance(kind, StructType):
            return _holds_text(kind)
        return isinstance(kind, (StringType, CharType, VarcharType))

    return any(text(f.dataType) for f in schema.fields)


def storage_of(info: TableInfo) -> Storage:
    """How new files of an existing table must be written so that the table reads them."""
    if info.provider not in (*PROVIDERS.values(), "hive"):
        raise ConfigError(f"{info.name} is stored as '{info.provider}', whose partitions are not plain directories")
    if info.provider == "hive":
        provider = PROVIDERS[SERDE_FORMATS.get(info.serde, "textfile")]
        options = _serde_text(info) if provider == "csv" else {}
    else:
        provider = info.provider
        options = {k: v for k, v in info.storage_properties.items() if k != "serialization.format"}
        if provider == "csv" and "sep" not in options and "field.delim" in options:
            options["sep"] = options["field.delim"]
    if provider == "csv":
        options = _TIMES | _CSV_WRITE | options
    elif provider == "json":
        options = _TIMES | _JSON_WRITE | options
    elif provider in ("parquet", "orc"):
        codec = info.table_properties.get("parquet.compression") or info.table_properties.get("orc.compression")
        if codec:
            options["compression"] = codec
    return Storage(provider, options)


def _serde_text(info: TableInfo) -> dict[str, str]:
    """The csv options that write what a text SerDe reads."""
    given = info.storage_properties
    if info.serde == "org.apache.hadoop.hive.serde2.OpenCSVSerde":
        return {
            "sep": given.get("separatorChar", ","),
            "quote": given.get("quoteChar", '"'),
            "escape": given.get("escapeChar", "\\"),
        }
    return {
        "sep": given.get("field.delim", "\u0001"),
        "nullValue": given.get("serialization.null.format", "\\N"),
        "emptyValue": "",
        "quote": "\u0000",
        "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    }
