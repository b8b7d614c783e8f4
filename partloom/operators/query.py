"""Run templated SQL, keep its result and a record of the run."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import timedelta

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    CalendarIntervalType,
    DayTimeIntervalType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
    YearMonthIntervalType,
)

from partloom.errors import QueryFailed, QueryTimeout
from partloom.operators.preview import Preview, preview as preview_rows, result_folder, view_of
from partloom.plans.limits import TEN_MINUTES, limited
from partloom.sources.access import note_access
from partloom.sources.catalog import literal, quote, unique_name
from partloom.sources.sqltext import load_sql, session_in
from partloom.sources.storage import make_directory

_RECORD = StructType(
    [
        StructField("id", StringType(), False),
        StructField("database", StringType()),
        StructField("workgroup", StringType()),
        StructField("query", StringType(), False),
        StructField("output", StringType()),
        StructField("scan_bytes", LongType()),
        StructField("exec_millis", LongType()),
        StructField("state", StringType(), False),
        StructField("state_change_reason", StringType()),
        StructField("submitted_at", LongType()),
        StructField("completed_at", LongType()),
    ]
)


_TEXT_TYPES = (NullType, CalendarIntervalType, DayTimeIntervalType, YearMonthIntervalType)


@dataclass(frozen=True)
class QueryRun:
    """One run of a query. ``frame`` reads the stored result.

    Like any stored table ``frame`` has no order of its own, whatever the ORDER BY of the
    statement: sort it again where order matters. ``preview`` does keep the statement's order.
    ``scan_bytes`` counts the files that were opened, null where the plan does not say what is read.
    """

    id: str
    query: str
    state: str
    database: str | None = None
    workgroup: str | None = None
    output: str | None = None
    scan_bytes: int | None = None
    exec_millis: int | None = None
    state_change_reason: str | None = None
    submitted_at: int | None = None
    completed_at: int | None = None
    frame: DataFrame | None = field(default=None, repr=False, compare=False)
    preview: Preview | None = field(default=None, repr=False, compare=False)

    def record(self, spark: SparkSession) -> DataFrame:
        """The run as a one-row DataFrame of its eleven fields."""
        values = {name: getattr(self, name) for name in _RECORD.names}
        return spark.createDataFrame([tuple(values.values())], _RECORD)


def query(
    spark: SparkSession,
    command: str | os.PathLike,
    *,
    params: Mapping | None = None,
    args: Mapping | list | None = None,
    database: str | None = None,
    catalog: str | None = None,
    workgroup: str | None = None,
    output: str | None = None,
    timeout: timedelta | None = TEN_MINUTES,
    preview: bool = False,
) -> QueryRun:
    """Run one statement and store its rows as parquet under ``output/<run id>/``.

    The statement runs once; the result, its preview and all later reads come
    from the stored rows, where columns of one name are numbered. ``params`` fill
    ``${name}`` as plain text, ``args`` are Spark's typed parameters for values that
    are not trusted. ``workgroup`` is only noted in the record.
    """
    text = load_sql(spark, command, params)
    run_id = str(uuid.uuid4())
    folder = result_folder(spark, run_id, output)
    started = time.time()
    run = QueryRun(id=run_id, query=text, state="RUNNING", database=database, workgroup=workgroup)
    try:
        frame, scanned = limited(spark, timeout, lambda: _run(spark, text, args, database, catalog, folder))
    except Exception as error:
        state = "CANCELLED" if isinstance(error, QueryTimeout) else "FAILED"
        raise QueryFailed(_finish(run, started, state=state, state_change_reason=str(error))) from error
    run = _finish(run, started, state="SUCCEEDED", scan_bytes=scanned, frame=frame)
    if frame.columns:
        frame.createOrReplaceTempView(view_of(run_id))
        run = replace(run, output=folder, preview=preview_rows(spark, run_id) if preview else None)
    return run


def _run(
    spark: SparkSession, text: str, args: Mapping | list | None, database: str | None, catalog: str | None, folder: str
) -> tuple[DataFrame, int | None]:
    """The stored rows of a statement, and how many bytes it has read."""
    frame = note_access(session_in(spark, database, catalog).sql(text, args=args))
    if not frame.columns:
        return frame, scan_bytes(frame)
    estimate = scan_bytes(frame)
    frame, plan = _store(spark, frame, folder)
    sizes = scanned_sizes(plan) if plan is not None else []
    return frame, sum(sizes) if sizes and estimate is not None else estimate


def _finish(run: QueryRun, started: float, **changes) -> QueryRun:
    ended = time.time()
    return replace(
        run,
        submitted_at=int(started),
        completed_at=int(ended),
        exec_millis=round((ended - started) * 1000),
        **changes,
    )


def _store(spark: SparkSession, frame: DataFrame, folder: str):
    """Write the rows once and read them from there on; with the plan that was run for it, metrics and all."""
    frame = frame.toDF(*_distinct(frame.columns))
    # Types that parquet files do not hold become text.
    as_text = [f.name for f in frame.schema.fields if isinstance(f.dataType, _TEXT_TYPES)]
    frame = frame.withColumns({name: frame[quote(name)].cast("string") for name in as_text})
    session, source, target = frame.sparkSession, unique_name("rows"), unique_name("result")
    make_directory(spark, folder)
    frame.createOrReplaceTempView(source)
    columns = frame._jdf.schema().asNullable().toDDL()
    try:
        # A writer keeps the plan it has run to itself, a statement does not.
        session.sql(f"CREATE TEMPORARY VIEW {target} ({columns}) USING parquet OPTIONS (path {literal(folder)})")
        done = session.sql(f"INSERT INTO {target} SELECT * FROM {source}")
    finally:
        session.catalog.dropTempView(source)
        session.catalog.dropTempView(target)
    return spark.read.schema(frame.schema).parquet(folder), _plan_run(done)


def _plan_run(frame: DataFrame):
    """The physical plan of a statement that ran on its own; None where it keeps that to itself."""
    try:
        plan = frame._jdf.queryExecution().optimizedPlan()
        return plan.commandPhysicalPlan() if plan.nodeName() == "CommandResult" else None
    except Py4JError:
        return None


def scanned_sizes(plan) -> list[int]:
    """Bytes of the files that each scan of a plan that was run has opened: after adaptive execution and
    after partitions were left out while it ran, before column pruning."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return scanned_sizes(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return scanned_sizes(plan.plan())
    if kind == "ReusedExchangeExec":
        return []
    metrics = plan.metrics()
    sizes = [int(metrics.apply("filesSize").value())] if metrics.contains("filesSize") else []
    for below in (plan.children(), plan.subqueries()):
        for i in range(below.size()):
            sizes += scanned_sizes(below.apply(i))
    return sizes


def _distinct(names: list[str]) -> list[str]:
    """Columns of one name, as ``SELECT *`` over a join gives them, get a number."""
    taken: set[str] = set()
    distinct = []
    for name in names:
        number, free = 1, name
        while free.lower() in taken:
            number += 1
            free = f"{name}_{number}"
        taken.add(free.lower())
        distinct.append(free)
    return distinct


def scan_bytes(frame: DataFrame) -> int | None:
    """Size of the files the plan reads, after partition and before column pruning.

    A statement that ran on its own (INSERT, CREATE TABLE AS SELECT) is asked for the plan it ran.
    Null where a table does not tell its size.
    """
    plan = frame._jdf.queryExecution().optimizedPlan()
    try:
        if plan.nodeName() == "CommandResult":
            plan = plan.commandLogicalPlan()
        return _scan_bytes(frame.sparkSession, plan)
    except Py4JError:  # a plan that does not tell
        return None


def _scan_bytes(spark: SparkSession, plan) -> int | None:
    # Commands keep their query out of the children.
    inner, total = plan.innerChildren(), 0
    parts = [plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())]
    if plan.nodeName() not in _RELATIONS and plan.children().isEmpty():
        parts = [inner.apply(i) for i in range(inner.size())]
    for part in parts:
        if part.nodeName() in _RELATIONS:
            size = _size_of(spark, part)
        elif part.equals(plan):
            size = 0
        else:
            size = _scan_bytes(spark, part)
        if size is None:
            return None
        total += size
    return total


# Leaves that read files or tables, and the size that Spark gives what it knows nothing of.
_RELATIONS = ("LogicalRelation", "HiveTableRelation", "RelationV2", "DataSourceV2ScanRelation", "DataSourceV2Relation")
_UNKNOWN_SIZE = 2**63 - 1


def _size_of(spark: SparkSession, relation) -> int | None:
    size = int(str(relation.stats().sizeInBytes()))
    if size < _UNKNOWN_SIZE:
        return size
    if relation.nodeName() != "LogicalRelation":
        return None
    # A partitioned table without statistics: its files are listed, as the scan did.
    none = spark.sparkContext._jvm.org.apache.spark.api.python.PythonUtils.toSeq(spark.sparkContext._jvm.java.util.ArrayList())
    return int(relation.relation().location().filterPartitions(none).sizeInBytes())
