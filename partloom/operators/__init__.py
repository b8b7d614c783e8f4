"""The operators a pipeline author calls."""

from partloom.operators.apas import apas, apas_many
from partloom.operators.ctas import CtasResult, ctas
from partloom.operators.databases import Database, database_inventory, for_each_database, list_databases
from partloom.operators.partitions import add_partition, drop_partition, partition_exists
from partloom.operators.preview import ColumnInfo, Preview, preview
from partloom.operators.query import QueryRun, query
from partloom.operators.recovery import recover
from partloom.operators.schema_diff import diff_schema
from partloom.operators.tables import Protect, drop_table, drop_table_multi, table_exists

__all__ = [
    "ColumnInfo",
    "CtasResult",
    "Database",
    "Preview",
    "Protect",
    "QueryRun",
    "add_partition",
    "apas",
    "apas_many",
    "ctas",
    "database_inventory",
    "diff_schema",
    "drop_partition",
    "drop_table",
    "drop_table_multi",
    "for_each_database",
    "list_databases",
    "partition_exists",
    "preview",
    "query",
    "recover",
    "table_exists",
]
