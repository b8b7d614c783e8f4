"""Every operator at work on the test tables, each with the SQL its result must equal.

A workload runs the operator, then reads back what the operator wrote. Tables and
files go to a database and a directory of its own, below the cluster's shared folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Mapping
from contextlib import contextmanager
from datetime import timedelta
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partloom import (
    Protect,
    add_partition,
    apas,
    apas_many,
    ctas,
    database_inventory,
    diff_schema,
    drop_partition,
    drop_table,
    drop_table_multi,
    for_each_database,
    partition_exists,
    preview,
    query,
    table_exists,
)
from partloom.errors import AlreadyExists, ConfigError, QueryFailed, SchemaMismatch
from partloom.plans.layout import union
from partloom.sources.catalog import NULL_PARTITION, escape_value
from partloom.sources.storage import for_each, shared_folder

_MOST_NAMES = 10_000

SQL = Path(__file__).parent / "sql"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def workload(oracle: str):
    """Register a function of a workspace under its own name, without a final underscore."""

    def register(run: Callable[[Workspace], DataFrame]):
        name = run.__name__.rstrip("_")
        QUERIES[name] = lambda spark, sf_dir: run(Workspace(spark, sf_dir))
        ORACLES[name] = oracle
        return run

    return register


class Workspace:
    """A database and a directory that one call has to itself.

    Its jobs may take as long as the tables are large, so no time limit is set.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.params = {"sf": str(sf_dir).rstrip("/")}
        token = uuid.uuid4().hex[:16]
        self.folder = f"{_shared(spark)}partloom/{token}/"
        self.database = self.new_database(f"loom_{token}")

    def new_database(self, name: str, comment: str = "") -> str:
        self.spark.sql(f"CREATE DATABASE {name} COMMENT '{comment}' LOCATION '{self.folder}{name}'")
        return name

    def source(self, table: str) -> str:
        return f"parquet.`{self.params['sf']}/{table}.parquet`"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.params['sf']}/{table}.parquet")

    def query(self, command, params: Mapping | None = None, **options):
        options.setdefault("output", f"{self.folder}results")
        options.setdefault("timeout", None)
        return query(self.spark, command, params=self.params | dict(params or {}), **options)

    def ctas(self, select: str, table: str, database: str | None = None, **options):
        database = database or self.database
        options.setdefault("location", f"{self.folder}{database}_files/{table}")
        options.setdefault("timeout", None)
        return ctas(self.spark, select, params=self.params, database=database, table=table, **options)

    def apas(self, select: str, table: str, params: Mapping | None = None, **options) -> DataFrame:
        merged = self.params | dict(params or {})
        options.setdefault("timeout", None)
        return apas(self.spark, select, params=merged, database=self.database, table=table, **options)

    def apas_many(self, select: str, table: str, **options) -> DataFrame:
        options.setdefault("timeout", None)
        return apas_many(self.spark, select, params=self.params, database=self.database, table=table, **options)

    def on(self, operator: Callable, table, **options) -> DataFrame:
        return operator(self.spark, database=self.database, table=table, **options)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def values(self, sql: str) -> list:
        """The few distinct values that name tables or partitions; more than a catalog should hold are refused."""
        rows = self.spark.sql(f"{sql} LIMIT {_MOST_NAMES + 1}").collect()
        if len(rows) > _MOST_NAMES:
            raise ConfigError(f"more than {_MOST_NAMES} values would each name a table or a partition")
        return sorted(tuple(row) for row in rows)

    def counts(self, database: str | None = None) -> DataFrame:
        """Rows of every table of a database."""
        database = database or self.database
        tables = self.spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary")
        names = [row.tableName for row in tables.collect()]
        frames = [
            self.spark.table(f"{database}.{name}").agg(F.count("*").alias("n")).withColumn("name", F.lit(name))
            for name in names
        ]
        return union(frames)


def _shared(spark: SparkSession) -> str:
    try:
        return shared_folder(spark)
    except ConfigError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        return tempfile.mkdtemp(prefix="run-") + "/"


@contextmanager
def refused(kind: type[Exception]):
    """The block must fail in this way."""
    try:
        yield
    except kind:
        return
    raise AssertionError(f"{kind.__name__} was expected")


def _filled(frame: DataFrame, label: str) -> DataFrame:
    """How many values each column holds: ``column`` and ``label``."""
    counted = frame.agg(*(F.count(name).alias(name) for name in frame.columns))
    return counted.unpivot([], counted.columns, "column", label)


# --- query -------------------------------------------------------------------

_PRICE = "CAST(l_extendedprice AS DECIMAL(12, 2))"
_NET = f"{_PRICE} * CAST(1 - l_discount AS DECIMAL(4, 2))"
_ORDERS = "SELECT * FROM orders"


@workload(f"""
    SELECT l_returnflag, l_linestatus,
           CAST(SUM(CAST(l_quantity AS DECIMAL(12, 2))) AS DOUBLE) AS sum_qty,
           CAST(SUM({_PRICE}) AS DOUBLE) AS sum_base_price,
           CAST(SUM({_NET}) AS DOUBLE) AS sum_disc_price,
           CAST(SUM({_NET} * CAST(1 + l_tax AS DECIMAL(4, 2))) AS DOUBLE) AS sum_charge,
           CAST(SUM(CAST(l_quantity AS DECIMAL(12, 2))) AS DOUBLE) / COUNT(*) AS avg_qty,
           COUNT(*) AS count_order
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02 00:00:00'
    GROUP BY l_returnflag, l_linestatus""")
def query_pricing_summary(w: Workspace) -> DataFrame:
    return w.query(SQL / "pricing_summary.sql", {"cutoff": "2001-09-02 00:00:00"}).frame


@workload(f"""
    SELECT c_name, o_orderkey, o_orderdate, CAST(revenue AS DOUBLE) AS revenue
    FROM (SELECT l_orderkey, SUM({_NET}) AS revenue FROM lineitem GROUP BY l_orderkey)
    JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    ORDER BY revenue DESC, o_orderkey LIMIT 10""")
def query_join_topk(w: Workspace) -> DataFrame:
    return w.query(SQL / "join_topk.sql", {"top": 10}).frame


@workload("""
    SELECT o_custkey, o_orderkey, o_totalprice, place
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
          FROM orders)
    WHERE place <= 3""")
def query_window_rank(w: Workspace) -> DataFrame:
    return w.query(SQL / "window_rank.sql", {"top": 3}).frame


@workload("""
    SELECT r_name, n_name, COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(12, 2))) AS DOUBLE) AS total
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    GROUP BY ROLLUP (r_name, n_name)""")
def query_rollup(w: Workspace) -> DataFrame:
    return w.query(SQL / "rollup.sql").frame


@workload("""
    SELECT date_trunc('hour', ts) AS hour, event_type, COUNT(*) AS n_events,
           COUNT(DISTINCT user_id) AS n_users, CAST(SUM(CAST(value AS DECIMAL(12, 2))) AS DOUBLE) AS total_value
    FROM events GROUP BY 1, 2""")
def query_events_hourly(w: Workspace) -> DataFrame:
    return w.query(SQL / "events_hourly.sql").frame


_STATUSES = "SELECT o_orderstatus, COUNT(*) AS n FROM parquet.`${sf}/orders.parquet` GROUP BY o_orderstatus"


@workload("SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus")
def query_uri(w: Workspace) -> DataFrame:
    """The statement comes from a file that is named by its URI."""
    w.spark.createDataFrame([(_STATUSES,)], "value string").coalesce(1).write.text(f"{w.folder}statement")
    return w.query(w.spark.read.text(f"{w.folder}statement").inputFiles()[0]).frame


@workload("SELECT COUNT(*) AS n, 'SUCCEEDED' AS state, true AS read_something, true AS took_time FROM orders")
def query_record(w: Workspace) -> DataFrame:
    """What is known of a run, next to its rows."""
    run = w.query("SELECT o_orderkey FROM parquet.`${sf}/orders.parquet`")
    told = run.record(w.spark).first()
    facts = {"state": told.state, "read_something": told.scan_bytes > 0, "took_time": told.exec_millis > 0}
    return run.frame.agg(F.count("*").alias("n")).withColumns({name: F.lit(value) for name, value in facts.items()})


@workload("SELECT COUNT(*) AS n, true AS read_the_pruned FROM orders WHERE o_orderstatus = 'P'")
def query_record_pruned(w: Workspace) -> DataFrame:
    """Partitions that a join rules out while it runs do not count as read."""
    w.ctas("SELECT * FROM parquet.`${sf}/orders.parquet`", "t", partitioned_by=["o_orderstatus"])
    names = "SELECT o_orderstatus AS status, upper(o_orderstatus) AS name FROM parquet.`${sf}/orders.parquet` GROUP BY 1"
    w.ctas(names, "names")
    joined = "SELECT o_orderkey FROM t JOIN names ON o_orderstatus = status WHERE name = 'P'"
    run = w.query(joined, database=w.database)
    files = w.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{w.folder}{w.database}_files")
    pruned = files.where(F.col("path").contains("o_orderstatus=P") | F.col("path").contains("/names/")).agg(F.sum("length"))
    told = run.record(w.spark).first().scan_bytes
    return run.frame.agg(F.count("*").alias("n")).withColumn("read_the_pruned", F.lit(told == pruned.first()[0]))


@workload("SELECT COUNT(*) AS n, 'FAILED' AS state, true AS says_why FROM orders")
def query_failed(w: Workspace) -> DataFrame:
    """A run that fails says so, and why."""
    try:
        w.query("SELECT assert_true(o_orderkey < 0, 'not below zero') AS a FROM parquet.`${sf}/orders.parquet`")
    except QueryFailed as error:
        told = error.run.record(w.spark)
    said = told.select("state", F.col("state_change_reason").contains("not below zero").alias("says_why")).first()
    return w.read("orders").agg(F.count("*").alias("n")).withColumns({name: F.lit(said[name]) for name in said.asDict()})


@workload("SELECT COUNT(*) AS n, 'CANCELLED' AS state FROM orders")
def query_timeout(w: Workspace) -> DataFrame:
    """A run that takes too long is cancelled."""
    # Pairs of orders, which end long after the limit.
    slow = (
        "SELECT COUNT(*) AS n FROM parquet.`${sf}/orders.parquet` a JOIN parquet.`${sf}/orders.parquet` b "
        "ON a.o_orderkey + b.o_orderkey + a.o_custkey * 7 <> b.o_custkey * 3 AND sqrt(a.o_totalprice) < b.o_totalprice"
    )
    try:
        state = w.query(slow, timeout=timedelta(milliseconds=50)).state
    except QueryFailed as error:
        state = error.run.state
    return w.read("orders").agg(F.count("*").alias("n")).withColumn("state", F.lit(state))


# --- preview -----------------------------------------------------------------


@workload("""
    SELECT CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(n_lines AS VARCHAR) AS n_lines, CAST(qty AS VARCHAR) AS qty
    FROM (SELECT l_partkey, COUNT(*) AS n_lines, SUM(CAST(l_quantity AS DECIMAL(12, 2))) AS qty
          FROM lineitem GROUP BY l_partkey)
    ORDER BY n_lines DESC, CAST(l_partkey AS BIGINT) LIMIT 10""")
def preview_rows(w: Workspace) -> DataFrame:
    run = w.query(
        "SELECT l_partkey, COUNT(*) AS n_lines, SUM(CAST(l_quantity AS DECIMAL(8, 2))) AS qty "
        "FROM parquet.`${sf}/lineitem.parquet` GROUP BY l_partkey ORDER BY n_lines DESC, l_partkey"
    )
    return preview(w.spark, run.id, max_rows=10).rows_frame(w.spark)


_ORDER_COLUMNS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@workload(
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, '{kind}' AS type, 'NULLABLE' AS nullable, COUNT({name}) AS n_values FROM orders"
        for name, kind in _ORDER_COLUMNS.items()
    )
)
def preview_columns(w: Workspace) -> DataFrame:
    run = w.query("SELECT * FROM parquet.`${sf}/orders.parquet`", preview=True)
    columns = run.preview.columns_frame(w.spark).select("name", "type", "nullable")
    filled = _filled(run.frame, "n_values").withColumnRenamed("column", "name")
    return columns.join(filled, "name")


# --- ctas --------------------------------------------------------------------


@workload(_ORDERS)
def ctas_parquet(w: Workspace) -> DataFrame:
    return w.ctas("SELECT * FROM parquet.`${sf}/orders.parquet`", "t").frame


@workload(_ORDERS)
def ctas_orc(w: Workspace) -> DataFrame:
    return w.ctas("SELECT * FROM parquet.`${sf}/orders.parquet`", "t", format="orc", compression="zlib").frame


@workload("SELECT * FROM events")
def ctas_json(w: Workspace) -> DataFrame:
    return w.ctas("SELECT * FROM parquet.`${sf}/events.parquet`", "t", format="json").frame


@workload("SELECT * FROM documents")
def ctas_textfile(w: Workspace) -> DataFrame:
    return w.ctas("SELECT * FROM parquet.`${sf}/documents.parquet`", "t", format="textfile").frame


@workload("SELECT * FROM conversations")
def ctas_textfile_tabs(w: Workspace) -> DataFrame:
    select = "SELECT * FROM parquet.`${sf}/conversations.parquet`"
    return w.ctas(select, "t", format="textfile", field_delimiter="\t").frame


_NUMBERS = """
    SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS place, unnest(embedding) AS number FROM embeddings"""


def _numbers(table: DataFrame) -> DataFrame:
    place = F.col("place").cast("bigint").alias("place")
    return table.select("vec_id", F.posexplode("embedding").alias("place", "number")).select("vec_id", place, "number")


@workload(_NUMBERS)
def ctas_orc_nested(w: Workspace) -> DataFrame:
    """Arrays go in and come back element by element."""
    return _numbers(w.ctas("SELECT * FROM parquet.`${sf}/embeddings.parquet`", "t", format="orc").frame)


@workload(_NUMBERS)
def ctas_json_nested(w: Workspace) -> DataFrame:
    return _numbers(w.ctas("SELECT * FROM parquet.`${sf}/embeddings.parquet`", "t", format="json").frame)


@workload("SELECT * FROM lineitem")
def ctas_partitioned(w: Workspace) -> DataFrame:
    select = "SELECT * FROM parquet.`${sf}/lineitem.parquet`"
    return w.ctas(select, "t", partitioned_by=["l_returnflag", "l_linestatus"]).frame


@workload(_ORDERS)
def ctas_bucketed(w: Workspace) -> DataFrame:
    select = "SELECT * FROM parquet.`${sf}/orders.parquet`"
    return w.ctas(select, "t", bucketed_by=["o_custkey"], bucket_count=8).frame


@workload("""
    SELECT o_orderstatus, COUNT(*) AS n_source, CAST(0 AS BIGINT) AS n_table FROM orders GROUP BY o_orderstatus""")
def ctas_empty(w: Workspace) -> DataFrame:
    empty = w.ctas("SELECT * FROM parquet.`${sf}/orders.parquet`", "t", table_mode="empty").frame
    both = w.read("orders").withColumn("n", F.lit(1)).unionByName(empty.withColumn("n", F.lit(0)))
    return both.groupBy("o_orderstatus").agg(
        F.sum("n").alias("n_source"), F.sum(1 - F.col("n")).alias("n_table")
    )


@workload("SELECT * FROM customer")
def ctas_data_only(w: Workspace) -> DataFrame:
    select = "SELECT * FROM parquet.`${sf}/customer.parquet`"
    return w.ctas(select, "t", table_mode="data_only", partitioned_by=["c_mktsegment"]).frame


@workload("""
    SELECT o_custkey, COUNT(*) AS n_orders, MAX(o_totalprice) AS highest FROM orders GROUP BY o_custkey""")
def ctas_overwrite(w: Workspace) -> DataFrame:
    w.ctas("SELECT * FROM parquet.`${sf}/orders.parquet`", "t", partitioned_by=["o_orderpriority"])
    # The second SELECT reads the table it replaces.
    second = "SELECT o_custkey, COUNT(*) AS n_orders, MAX(o_totalprice) AS highest FROM t GROUP BY o_custkey"
    return w.ctas(second, "t", save_mode="overwrite").frame


@workload("SELECT * FROM supplier")
def ctas_ignore(w: Workspace) -> DataFrame:
    w.ctas("SELECT * FROM parquet.`${sf}/supplier.parquet`", "t", save_mode="ignore")
    return w.ctas("SELECT * FROM parquet.`${sf}/part.parquet`", "t", save_mode="ignore").frame


@workload("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def ctas_overwrite_partitioned(w: Workspace) -> DataFrame:
    """A partitioned table replaced at its place by a SELECT from itself, then by switching directories."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    w.ctas("SELECT * FROM t WHERE o_orderstatus <> 'P'", "t", partitioned_by=["o_orderstatus"])
    doubled = "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_orderstatus FROM t"
    w.ctas(doubled, "t", partitioned_by=["o_orderstatus"], relocate=True)
    return w.table("t")


@workload("SELECT * FROM customer")
def ctas_generated_name(w: Workspace) -> DataFrame:
    """Without a name the call makes one up; a final semicolon is no harm."""
    made = w.ctas("SELECT * FROM parquet.`${sf}/customer.parquet`;\n", None, location=None)
    return w.spark.table(made.table.sql)


@workload("SELECT COUNT(*) AS n, 'sales' AS owner FROM customer")
def ctas_properties(w: Workspace) -> DataFrame:
    """Properties of the author's choice are kept with the table."""
    w.ctas("SELECT * FROM parquet.`${sf}/customer.parquet`", "t", additional_properties={"made.for": "sales"})
    kept = w.spark.sql(f"SHOW TBLPROPERTIES {w.database}.t ('made.for')").first()["value"]
    return w.table("t").agg(F.count("*").alias("n")).withColumn("owner", F.lit(kept))


@workload("SELECT * FROM supplier")
def ctas_error_if_exists(w: Workspace) -> DataFrame:
    """The first table is made, the second call is an error and changes nothing."""
    w.ctas("SELECT * FROM parquet.`${sf}/supplier.parquet`", "t", save_mode="error_if_exists")
    with refused(AlreadyExists):
        w.ctas("SELECT * FROM parquet.`${sf}/part.parquet`", "t", save_mode="error_if_exists")
    return w.table("t")


@workload("SELECT p_partkey, p_name || ';' AS p_name FROM part")
def ctas_semicolon(w: Workspace) -> DataFrame:
    """A statement may end as in a script; a semicolon within it stays."""
    w.ctas("SELECT p_partkey, p_name || ';' AS p_name FROM parquet.`${sf}/part.parquet` ;\n", "t")
    return w.table("t")


@workload("SELECT * FROM part")
def ctas_none(w: Workspace) -> DataFrame:
    """No checks of our own: Spark makes the first table and refuses the second."""
    w.ctas("SELECT * FROM parquet.`${sf}/part.parquet`", "t", save_mode="none")
    with refused(AnalysisException):
        w.ctas("SELECT * FROM parquet.`${sf}/supplier.parquet`", "t", save_mode="none")
    return w.table("t")


# --- apas --------------------------------------------------------------------


@workload("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")
def apas_year(w: Workspace) -> DataFrame:
    """One partition per order year, each by a call of its own; the calls run side by side."""
    keyed = "SELECT *, year(o_orderdate) AS order_year FROM parquet.`${sf}/orders.parquet`"
    w.ctas(keyed, "t", table_mode="empty", partitioned_by=["order_year"])
    select = (
        "SELECT * FROM parquet.`${sf}/orders.parquet` "
        "WHERE o_orderdate >= TIMESTAMP_NTZ '${from}-01-01' AND o_orderdate < TIMESTAMP_NTZ '${to}-01-01'"
    )

    def store(year: int):
        w.apas(select, "t", {"from": year, "to": year + 1}, partition_kv={"order_year": str(year)})

    years = w.values(f"SELECT DISTINCT year(o_orderdate) FROM {w.source('orders')}")
    for_each(w.spark, store, [year for (year,) in years])
    return w.table("t")


@workload("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           o_orderstatus
    FROM orders""")
def apas_overwrite(w: Workspace) -> DataFrame:
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    # The SELECT reads the partition it replaces.
    doubled = "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM t WHERE o_orderstatus = 'F'"
    w.apas(doubled, "t", partition_kv={"o_orderstatus": "F"})
    return w.table("t")


@workload("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def apas_skip(w: Workspace) -> DataFrame:
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select + " WHERE o_orderstatus <> 'P'", "t", partitioned_by=["o_orderstatus"])
    for status in ("F", "P"):
        # F is there and stays as it is, P is new.
        w.apas(
            "SELECT o_orderkey, o_totalprice FROM parquet.`${sf}/orders.parquet` WHERE o_orderstatus = 'P'",
            "t",
            partition_kv={"o_orderstatus": status},
            save_mode="skip_if_exists",
        )
    return w.table("t")


@workload("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def apas_schema_diff_kept(w: Workspace) -> DataFrame:
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    with refused(SchemaMismatch):
        w.apas(
            "SELECT CAST(o_orderkey AS INT) AS o_orderkey, o_totalprice FROM parquet.`${sf}/orders.parquet`",
            "t",
            partition_kv={"o_orderstatus": "F"},
        )
    return w.table("t")


@workload("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def apas_error_if_exists(w: Workspace) -> DataFrame:
    """P is new and is stored, F is there and stays as it is."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select + " WHERE o_orderstatus <> 'P'", "t", partitioned_by=["o_orderstatus"])
    new = "SELECT o_orderkey, o_totalprice FROM parquet.`${sf}/orders.parquet` WHERE o_orderstatus = 'P'"
    w.apas(new, "t", partition_kv={"o_orderstatus": "P"}, save_mode="error_if_exists")
    with refused(AlreadyExists):
        w.apas(new, "t", partition_kv={"o_orderstatus": "F"}, save_mode="error_if_exists")
    return w.table("t")


@workload("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def apas_empty(w: Workspace) -> DataFrame:
    """A SELECT without rows takes the partition away."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    nothing = "SELECT o_orderkey, o_totalprice FROM parquet.`${sf}/orders.parquet` WHERE o_totalprice < 0"
    w.apas(nothing, "t", partition_kv={"o_orderstatus": "F"})
    return w.table("t")


@workload("SELECT * FROM orders")
def apas_location(w: Workspace) -> DataFrame:
    """Partitions at places of the author's choice, their files in four buckets."""
    w.ctas("SELECT * FROM parquet.`${sf}/orders.parquet`", "t", table_mode="empty", partitioned_by=["o_orderstatus"])
    select = (
        "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority "
        "FROM parquet.`${sf}/orders.parquet` WHERE o_orderstatus = :status"
    )

    def store(status: str):
        w.apas(
            select,
            "t",
            args={"status": status},
            partition_kv={"o_orderstatus": status},
            location=f"{w.folder}elsewhere/{status}",
            bucketed_by=["o_custkey"],
            bucket_count=4,
        )

    statuses = w.values(f"SELECT DISTINCT o_orderstatus FROM {w.source('orders')}")
    for_each(w.spark, store, [status for (status,) in statuses])
    return w.table("t")


@workload("SELECT * FROM documents")
def apas_textfile(w: Workspace) -> DataFrame:
    """Format and delimiter are those of the table."""
    w.ctas(
        "SELECT * FROM parquet.`${sf}/documents.parquet`",
        "t",
        table_mode="empty",
        format="textfile",
        field_delimiter="|",
        partitioned_by=["lang"],
    )
    select = "SELECT doc_id, text, source, n_chars FROM parquet.`${sf}/documents.parquet` WHERE lang = :lang"

    def store(lang: str):
        w.apas(select, "t", args={"lang": lang}, partition_kv={"lang": lang})

    for_each(w.spark, store, [lang for (lang,) in w.values(f"SELECT DISTINCT lang FROM {w.source('documents')}")])
    return w.table("t")


@workload("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           o_orderstatus
    FROM orders""")
def apas_overwrite_relocate(w: Workspace) -> DataFrame:
    """The catalog is pointed to the new rows; no file is moved."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    doubled = "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM t WHERE o_orderstatus = 'F'"
    w.apas(doubled, "t", partition_kv={"o_orderstatus": "F"}, relocate=True)
    return w.table("t")


@workload("SELECT o_orderstatus, COUNT(*) AS n, true AS packed FROM orders GROUP BY o_orderstatus")
def apas_codec(w: Workspace) -> DataFrame:
    """New files are compressed as those of the table, or as asked for."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(f"{select} WHERE o_orderstatus = 'O'", "t", partitioned_by=["o_orderstatus"], compression="gzip")
    for status, options in {"F": {}, "P": {"additional_properties": {"compression": "gzip"}}}.items():
        data = f"SELECT o_orderkey, o_totalprice FROM parquet.`${{sf}}/orders.parquet` WHERE o_orderstatus = '{status}'"
        w.apas(data, "t", partition_kv={"o_orderstatus": status}, **options)
    packed = F.bool_and(F.col("_metadata.file_name").endswith(".gz.parquet")).alias("packed")
    return w.table("t").groupBy("o_orderstatus").agg(F.count("*").alias("n"), packed)


@workload("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderstatus
    FROM orders""")
def apas_schema_diff_ignored(w: Workspace) -> DataFrame:
    """A column that the SELECT lacks is null, one that the table lacks is not seen."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    other = "SELECT o_orderkey, o_custkey AS extra FROM parquet.`${sf}/orders.parquet` WHERE o_orderstatus = 'F'"
    w.apas(other, "t", partition_kv={"o_orderstatus": "F"}, ignore_schema_diff=True)
    return w.table("t")


@workload("SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders")
def apas_many_(w: Workspace) -> DataFrame:
    """One partition per order year, all of them from one scan of the source."""
    keyed = "SELECT *, year(o_orderdate) AS order_year FROM parquet.`${sf}/orders.parquet`"
    w.ctas(keyed, "t", table_mode="empty", partitioned_by=["order_year"])
    w.apas_many(keyed, "t")
    return w.table("t")


@workload("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           o_orderstatus
    FROM orders WHERE o_orderstatus <> 'P'""")
def apas_many_overwrite(w: Workspace) -> DataFrame:
    """F is doubled from its own rows, P is expected, gets none and goes, O is not named and stays."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    doubled = "SELECT o_orderstatus, o_orderkey, o_totalprice * 2 AS o_totalprice FROM t WHERE o_orderstatus = 'F'"
    w.apas_many(doubled, "t", expected=[{"o_orderstatus": "F"}, {"o_orderstatus": "P"}])
    return w.table("t")


@workload("SELECT 'kept' AS action, COUNT(DISTINCT l_returnflag || l_linestatus) AS n_partitions, SUM(l_quantity) AS quantity FROM lineitem")
def apas_many_skip(w: Workspace) -> DataFrame:
    """Two keys; what is there is kept, and new files stay where they were written."""
    select = "SELECT l_orderkey, l_quantity, l_returnflag, l_linestatus FROM parquet.`${sf}/lineitem.parquet`"
    w.ctas(select, "t", table_mode="empty", partitioned_by=["l_returnflag", "l_linestatus"])
    w.apas_many(select, "t", relocate=True)
    tripled = select.replace("l_quantity", "l_quantity * 3 AS l_quantity")
    told = w.apas_many(tripled, "t", save_mode="skip_if_exists")
    sums = w.table("t").agg(F.sum("l_quantity").alias("quantity"))
    return told.groupBy("action").agg(F.count("*").alias("n_partitions")).crossJoin(F.broadcast(sums))


@workload("""
    SELECT o_orderstatus, c_mktsegment, COUNT(*) AS n, true AS without_shuffle
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_orderstatus, c_mktsegment""")
def apas_buckets(w: Workspace) -> DataFrame:
    """Partitions of a table with buckets are in those, so that a join on them moves no rows."""
    select = "SELECT o_orderkey, o_custkey, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    buckets = {"bucketed_by": ["o_custkey"], "bucket_count": 4}
    w.ctas(select, "t", table_mode="empty", partitioned_by=["o_orderstatus"], **buckets)
    data = "SELECT o_orderkey, o_custkey FROM parquet.`${sf}/orders.parquet` WHERE o_orderstatus = 'F'"
    w.apas(data, "t", partition_kv={"o_orderstatus": "F"})
    w.apas_many(f"{select} WHERE o_orderstatus <> 'F'", "t")
    customers = "SELECT c_custkey, c_mktsegment FROM parquet.`${sf}/customer.parquet`"
    w.ctas(customers, "c", bucketed_by=["c_custkey"], bucket_count=4)
    joined = w.table("t").join(w.table("c").hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
    still = "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    return joined.groupBy("o_orderstatus", "c_mktsegment").agg(F.count("*").alias("n")).withColumn("without_shuffle", F.lit(still))


@workload("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def apas_refused(w: Workspace) -> DataFrame:
    """What cannot take the partition is refused before anything is written."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    w.ctas("SELECT * FROM parquet.`${sf}/part.parquet`", "flat")
    data = "SELECT o_orderkey, o_totalprice FROM parquet.`${sf}/orders.parquet`"
    inside = f"{w.folder}{w.database}_files/t"
    for table, spec, options in (
        ("nowhere", {"o_orderstatus": "F"}, {}),
        ("flat", {"o_orderstatus": "F"}, {}),
        ("t", {"other": "F"}, {}),
        ("t", {"o_orderstatus": "F"}, {"location": inside}),
        ("t", {"o_orderstatus": "new"}, {"location": f"{inside}/o_orderstatus=F"}),
    ):
        with refused(ConfigError):
            w.apas(data, table, partition_kv=spec, **options)
    return w.table("t")


# --- diff_schema -------------------------------------------------------------


@workload("""
    SELECT 'o_orderkey' AS "column", 'bigint' AS original_type, 'bigint' AS comparison_type, 'both' AS side,
           COUNT(o_orderkey) AS n_values FROM orders
    UNION ALL SELECT 'o_custkey', 'bigint', NULL, 'left_only', COUNT(o_custkey) FROM orders
    UNION ALL SELECT 'o_custkey', NULL, 'string', 'right_only', COUNT(o_custkey) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'string', NULL, 'left_only', COUNT(o_orderpriority) FROM orders
    UNION ALL SELECT 'order_year', NULL, 'int', 'right_only', COUNT(o_orderdate) FROM orders""")
def diff_schema_(w: Workspace) -> DataFrame:
    """The differing columns of two tables, and how many values each holds."""
    w.ctas(
        "SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM parquet.`${sf}/orders.parquet`",
        "original",
        partitioned_by=["o_orderstatus"],
    )
    w.ctas(
        "SELECT year(o_orderdate) AS order_year, CAST(o_custkey AS STRING) AS o_custkey, o_orderkey "
        "FROM parquet.`${sf}/orders.parquet`",
        "changed",
    )
    diff = diff_schema(
        w.spark, database=w.database, original="original", comparison="changed", error_if_diff_found=False
    )
    left, right = _filled(w.table("original"), "n_left"), _filled(w.table("changed"), "n_right")
    n_values = F.when(F.col("side") == "right_only", F.col("n_right")).otherwise(F.col("n_left"))
    return (
        diff.join(left, "column", "left").join(right, "column", "left").select(*diff.columns, n_values.alias("n_values"))
    )


# --- partitions --------------------------------------------------------------

_KEYED = "SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM parquet.`${sf}/orders.parquet`"
_KEYED_ORDERS = "SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders"


def _keyed_orders(w: Workspace) -> list[dict[str, str]]:
    """Orders by status and priority, and the spec of every partition."""
    w.ctas(_KEYED, "t", partitioned_by=["o_orderstatus", "o_orderpriority"])
    pairs = w.values(f"SELECT DISTINCT o_orderstatus, o_orderpriority FROM {w.source('orders')}")
    return [{"o_orderstatus": status, "o_orderpriority": priority} for status, priority in pairs]


@workload(_KEYED_ORDERS)
def add_partition_(w: Workspace) -> DataFrame:
    """Partitions dropped without their files come back from those files."""
    specs = _keyed_orders(w)
    w.on(drop_partition, "t", partition_kv=specs)
    w.on(add_partition, "t", partition_kv=specs)
    return w.table("t")


@workload(_KEYED_ORDERS)
def add_partition_files(w: Workspace) -> DataFrame:
    """Many partitions from one SELECT: one job writes the files, one call registers them."""
    keys = ["o_orderstatus", "o_orderpriority"]
    w.ctas(_KEYED, "t", table_mode="empty", partitioned_by=keys)
    files = w.ctas(_KEYED, "files", table_mode="data_only", partitioned_by=keys).location
    pairs = w.values(f"SELECT DISTINCT o_orderstatus, o_orderpriority FROM {w.source('orders')}")
    specs = [dict(zip(keys, pair)) for pair in pairs]
    places = [f"{files}o_orderstatus={status}/o_orderpriority={priority}" for status, priority in pairs]
    w.on(add_partition, "t", partition_kv=specs, location=places)
    return w.table("t")


@workload(_KEYED_ORDERS + " WHERE o_orderstatus <> 'F'")
def add_partition_follow(w: Workspace) -> DataFrame:
    """A partition pointed at a location without objects goes."""
    specs = [spec for spec in _keyed_orders(w) if spec["o_orderstatus"] == "F"]
    w.on(add_partition, "t", partition_kv=specs, location=[f"{w.folder}nowhere"] * len(specs))
    return w.table("t")


@workload("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice, o_orderstatus
    FROM orders""")
def add_partition_relocate(w: Workspace) -> DataFrame:
    """A partition that is there is pointed at other files."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    zeroed = (
        "SELECT o_orderkey, CAST(0 AS DOUBLE) AS o_totalprice FROM parquet.`${sf}/orders.parquet` "
        "WHERE o_orderstatus = 'F'"
    )
    other = w.ctas(zeroed, "files", table_mode="data_only").location
    w.on(add_partition, "t", partition_kv={"o_orderstatus": "F"}, location=other)
    return w.table("t")


@workload("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def add_partition_skip(w: Workspace) -> DataFrame:
    """Partitions that are there stay where they are, by leave or by error."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    doubled = "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM parquet.`${sf}/orders.parquet`"
    other = w.ctas(doubled, "files", table_mode="data_only").location
    spec = {"o_orderstatus": "F"}
    w.on(add_partition, "t", partition_kv=spec, location=other, save_mode="skip_if_exists")
    with refused(AlreadyExists):
        w.on(add_partition, "t", partition_kv=spec, location=other, save_mode="error_if_exists")
    return w.table("t")


@workload("""
    SELECT o_orderstatus, true AS partition_exists, o_orderstatus <> 'F' AS location_exists,
           CASE WHEN o_orderstatus = 'F' THEN 0 ELSE COUNT(*) END AS n
    FROM orders GROUP BY o_orderstatus""")
def add_partition_unfollowed(w: Workspace) -> DataFrame:
    """Without a look at the files, a partition may point to a place without objects."""
    select = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(select, "t", partitioned_by=["o_orderstatus"])
    w.on(add_partition, "t", partition_kv={"o_orderstatus": "F"}, location=f"{w.folder}nowhere", follow_location=False)
    statuses = w.values(f"SELECT DISTINCT o_orderstatus FROM {w.source('orders')}")
    found = w.on(partition_exists, "t", partition_kv=[{"o_orderstatus": s} for (s,) in statuses], with_location=True)
    counts = w.table("t").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return found.join(counts, "o_orderstatus", "left").fillna(0, ["n"])


@workload(_KEYED_ORDERS)
def add_partition_refused(w: Workspace) -> DataFrame:
    """Absent tables, flat ones and incomplete specs are refused."""
    specs = _keyed_orders(w)
    w.ctas("SELECT * FROM parquet.`${sf}/part.parquet`", "flat")
    for table, spec in (("nowhere", specs[0]), ("flat", specs[0]), ("t", {"o_orderstatus": "F"}), ("t", [specs[0], specs[0]])):
        with refused(ConfigError):
            w.on(add_partition, table, partition_kv=spec)
    return w.table("t")


@workload(_KEYED_ORDERS + " WHERE o_orderpriority <> '5-LOW'")
def drop_partition_(w: Workspace) -> DataFrame:
    specs = [spec for spec in _keyed_orders(w) if spec["o_orderpriority"] == "5-LOW"]
    w.on(drop_partition, "t", partition_kv=specs, with_location=True)
    return w.table("t")


@workload("""
    SELECT o_orderstatus, o_orderpriority, o_orderstatus <> 'P' AS partition_exists,
           o_orderstatus <> 'P' AS location_exists, COUNT(*) AS n_orders
    FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def partition_exists_(w: Workspace) -> DataFrame:
    """Which (status, priority) groups of the source have a partition."""
    specs = _keyed_orders(w)
    w.on(drop_partition, "t", partition_kv=[s for s in specs if s["o_orderstatus"] == "P"], with_location=True)
    found = w.on(partition_exists, "t", partition_kv=specs, with_location=True)
    keys = ["o_orderstatus", "o_orderpriority"]
    return w.read("orders").groupBy(*keys).agg(F.count("*").alias("n_orders")).join(found, keys)


@workload("""
    SELECT o_orderstatus, o_orderstatus <> '' AS alone, o_orderstatus <> '' AS listed, COUNT(*) AS n
    FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN '__HIVE_DEFAULT_PARTITION__' ELSE o_orderstatus END AS o_orderstatus
          FROM orders UNION ALL SELECT '' FROM orders)
    GROUP BY o_orderstatus""")
def partition_exists_single(w: Workspace) -> DataFrame:
    """One spec and a list get the same answer, also for the null partition and an empty value."""
    nulled = "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus FROM parquet.`${sf}/orders.parquet`"
    w.ctas(nulled, "t", partitioned_by=["o_orderstatus"])
    orders = w.read("orders")
    statuses = orders.select(F.when(F.col("o_orderstatus") == "P", NULL_PARTITION).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    statuses = statuses.unionByName(orders.select(F.lit("").alias("o_orderstatus")))
    counts = statuses.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    specs = [{"o_orderstatus": status} for status in ("F", "O", NULL_PARTITION, "")]
    listed = w.on(partition_exists, "t", partition_kv=specs).select("o_orderstatus", F.col("partition_exists").alias("listed"))
    alone = union([w.on(partition_exists, "t", partition_kv=spec) for spec in specs])
    alone = alone.select("o_orderstatus", F.col("partition_exists").alias("alone"))
    return counts.join(alone, "o_orderstatus").join(listed, "o_orderstatus")


# --- tables ------------------------------------------------------------------


def _named(prefix: str, value: str) -> str:
    """The table of a value; ``_SQL_NAMED`` says the same."""
    return f"{prefix}_" + re.sub("[^0-9a-z]+", "_", value.lower())


_SQL_NAMED = "'{0}_' || regexp_replace(lower({1}), '[^0-9a-z]+', '_', 'g')"


def _table_per_value(w: Workspace, prefix: str, table: str, column: str) -> list[str]:
    """A table per value of a column: one job writes a directory per value, and each becomes a table."""
    select = f"SELECT *, {column} AS of_table FROM parquet.`${{sf}}/{table}.parquet`"
    files = w.ctas(select, "files", table_mode="data_only", partitioned_by=["of_table"]).location
    values = [value for (value,) in w.values(f"SELECT DISTINCT {column} FROM {w.source(table)}")]
    named = [_named(prefix, value) for value in values]
    if len(set(named)) < len(named):
        raise ConfigError(f"two values of {column} name one table: {values}")

    def define(pair: tuple[str, str]) -> None:
        place = f"{files}of_table={escape_value(pair[1])}/"
        w.spark.sql(f"CREATE TABLE {w.database}.{pair[0]} USING parquet LOCATION '{place}'")

    for_each(w.spark, define, zip(named, values))
    return values


def _table_per_type(w: Workspace) -> list[str]:
    return _table_per_value(w, "events", "events", "event_type")


@workload("""
    SELECT event_type, event_type <> 'error' AS table_exists, event_type <> 'error' AS location_exists,
           COUNT(*) AS n_events
    FROM events GROUP BY event_type""")
def table_exists_(w: Workspace) -> DataFrame:
    kinds = _table_per_type(w)
    w.on(drop_table, "events_error", with_location=True)
    names = {kind: _named("events", kind) for kind in kinds}
    found = w.on(table_exists, list(names.values()), with_location=True)
    told = w.spark.createDataFrame(list(names.items()), "event_type string, table string")
    found = told.join(found, "table").select("event_type", "table_exists", "location_exists")
    return w.read("events").groupBy("event_type").agg(F.count("*").alias("n_events")).join(found, "event_type")


@workload(f"""
    SELECT {_SQL_NAMED.format("events", "event_type")} AS name, COUNT(*) AS n FROM events
    WHERE event_type NOT IN ('error', 'view') GROUP BY event_type""")
def drop_table_(w: Workspace) -> DataFrame:
    _table_per_type(w)
    w.on(drop_table, ["events_error", "events_view", "events_nowhere"], with_location=True)
    return w.counts()


_PRIORITIES = f"SELECT {_SQL_NAMED.format('prio', 'o_orderpriority')} AS name, COUNT(*) AS n FROM orders"


@workload(f"{_PRIORITIES} WHERE left(o_orderpriority, 1) IN ('3', '4', '5') GROUP BY o_orderpriority")
def drop_table_multi_(w: Workspace) -> DataFrame:
    """Three names match, the limit lets the first two go."""
    _table_per_value(w, "prio", "orders", "o_orderpriority")
    drop_table_multi(w.spark, database=w.database, regexp="prio_[123].*", limit=2, with_location=True)
    return w.counts()


_EVENTS = f"SELECT {_SQL_NAMED.format('events', 'event_type')} AS name, COUNT(*) AS n FROM events"


@workload(f"{_EVENTS} GROUP BY event_type")
def drop_table_multi_protected(w: Workspace) -> DataFrame:
    """Every name matches, but the tables are young."""
    _table_per_type(w)
    for protect in (Protect(created_within=timedelta(days=1)), Protect(updated_within=timedelta(days=1))):
        drop_table_multi(w.spark, database=w.database, regexp="events_.*", protect=protect, with_location=True)
    return w.counts()


@workload(f"{_EVENTS} WHERE event_type <> 'view' GROUP BY event_type")
def drop_table_multi_accessed(w: Workspace) -> DataFrame:
    """The catalog keeps no time of access, so that protects nothing."""
    _table_per_type(w)
    protect = Protect(accessed_within=timedelta(days=1))
    drop_table_multi(w.spark, database=w.database, regexp="events_view", protect=protect)
    return w.counts()


@workload(f"{_EVENTS} WHERE event_type = 'view' GROUP BY event_type")
def drop_table_multi_read(w: Workspace) -> DataFrame:
    """A table that a query has read a moment ago is kept, the others go."""
    _table_per_type(w)
    w.query("SELECT * FROM events_view LIMIT 1", database=w.database)
    drop_table_multi(w.spark, database=w.database, regexp="events_.*", protect=Protect(accessed_within=timedelta(days=1)))
    return w.counts()


@workload(f"{_EVENTS} GROUP BY event_type")
def drop_table_multi_refused(w: Workspace) -> DataFrame:
    """Without an expression nothing is dropped; an expression must match a whole name."""
    _table_per_type(w)
    with refused(ConfigError):
        drop_table_multi(w.spark, database=w.database, regexp="", with_location=True)
    drop_table_multi(w.spark, database=w.database, regexp="events", with_location=True)
    return w.counts()


# --- databases ---------------------------------------------------------------


@workload(
    " UNION ALL ".join(
        f"SELECT '{shop}' AS shop, '{name}' AS name, COUNT(*) AS n FROM {name}"
        for shop, names in {"goods": ("part", "supplier"), "sales": ("customer", "orders")}.items()
        for name in names
    )
)
def for_each_database_(w: Workspace) -> DataFrame:
    """Rows of every table in two databases, which their comments name."""
    for shop, names in {"goods": ("part", "supplier"), "sales": ("customer", "orders")}.items():
        database = w.new_database(f"{w.database}_{shop}", comment=shop)
        for name in names:
            w.ctas(f"SELECT * FROM parquet.`${{sf}}/{name}.parquet`", name, database=database)
    counts = for_each_database(
        w.spark,
        lambda d: w.counts(d.name).withColumn("shop", F.lit(d.description)),
        regexp=f"{w.database}_.*",
    )
    return counts.drop("database")


@workload("SELECT 'part' AS description, COUNT(*) AS n FROM part UNION ALL SELECT 'orders', COUNT(*) FROM orders")
def database_inventory_(w: Workspace) -> DataFrame:
    """What is known of the databases, and the rows that each holds."""
    for name in ("part", "orders"):
        database = w.new_database(f"{w.database}_{name}", comment=name)
        w.ctas(f"SELECT * FROM parquet.`${{sf}}/{name}.parquet`", "t", database=database)
    found = database_inventory(w.spark, regexp=f"{w.database}_.*")
    counts = for_each_database(w.spark, lambda d: w.counts(d.name), regexp=f"{w.database}_.*", parallel=2)
    return found.select("description", F.col("name").alias("database")).join(counts, "database").select("description", "n")
