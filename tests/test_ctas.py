from datetime import timedelta
from pathlib import Path

import pytest
from conftest import rows

from partloom import ctas
from partloom.errors import AlreadyExists, ConfigError, QueryTimeout
from partloom.sources.storage import has_objects

ONE, TWO = "select 1 as a", "select 2 as a"

# What text formats tend to lose: line ends, quotes, blanks, null against empty, microseconds.
NASTY = r"""
select * from values
  (1, 'plain', timestamp_ntz '2020-01-01 00:00:00.000001', 1.5D),
  (2, 'two\nlines', timestamp_ntz '2020-01-01 23:59:59.999999', double('NaN')),
  (3, 'a "quoted" word', null, double('Infinity')),
  (4, '  blanks around  ', timestamp_ntz '1969-12-31 23:59:59.5', -0.1D),
  (5, '', null, null),
  (6, null, null, 1e300D),
  (7, 'back\\slash\\', null, 0D),
  (8, 'sep\u0001inside, and , comma \t tab | bar', null, 3.3D),
  (9, 'cr\r\nlf \r alone', null, 4D),
  (10, '"', null, 5D),
  (11, '#comment', null, 6D),
  (12, '{"json": [1]}', null, 7D),
  (13, '\\"', null, 8D),
  (14, 'ünï ☃ 漢字', null, 9D)
  as t(id, s, t, d)
"""


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "textfile"])
def test_formats_keep_every_value(spark, db, folder, format):
    made = ctas(spark, NASTY, database=db, table="t", location=f"{folder}t", format=format)
    assert made.created and repr(rows(made.frame)) == repr(rows(spark.sql(NASTY)))
    assert made.frame.schema.simpleString() == spark.sql(NASTY).schema.simpleString()


@pytest.mark.parametrize("delimiter", [",", "\t", "|", ";"])
def test_field_delimiter(spark, db, folder, delimiter):
    made = ctas(
        spark, NASTY, database=db, table="t", location=f"{folder}t", format="textfile", field_delimiter=delimiter
    )
    assert repr(rows(made.frame)) == repr(rows(spark.sql(NASTY)))
    text = "".join(r.value for r in spark.read.text(made.location).collect())
    assert delimiter in text


@pytest.mark.parametrize("format", ["json", "textfile"])
def test_zoned_times_keep_microseconds(spark, db, folder, format):
    select = "select timestamp '2020-06-01 12:00:00.123456 UTC' as t, date '2020-02-29' as d"
    made = ctas(spark, select, database=db, table="t", location=f"{folder}t", format=format)
    assert rows(made.frame) == rows(spark.sql(select))


NESTED = """
select id, array(id, null, 3) as arr, map('k', id, 'null', null) as m,
       named_struct('x', id, 'y', array('a', null)) as s, cast(id as decimal(20, 3)) as d
from range(4)
"""


@pytest.mark.parametrize("format", ["parquet", "orc", "json"])
def test_nested_columns(spark, db, folder, format):
    made = ctas(spark, NESTED, database=db, table="t", location=f"{folder}t", format=format)
    assert rows(made.frame) == rows(spark.sql(NESTED))


def test_textfile_refuses_nested_columns(spark, db, folder):
    with pytest.raises(Exception, match="UNSUPPORTED_DATA_TYPE"):
        ctas(spark, NESTED, database=db, table="t", location=f"{folder}t", format="textfile")
    assert not spark.catalog.tableExists(f"{db}.t")


@pytest.mark.parametrize("format, codec", [("parquet", "gzip"), ("orc", "zlib"), ("parquet", "snappy")])
def test_compression(spark, db, folder, format, codec):
    made = ctas(spark, ONE, database=db, table="t", location=f"{folder}t", format=format, compression=codec)
    suffix = {"gzip": ".gz.parquet", "zlib": ".zlib.orc", "snappy": ".snappy.parquet"}[codec]
    assert all(path.endswith(suffix) for path in made.frame.inputFiles())


def test_avro_needs_its_package(spark, db, folder):
    with pytest.raises(ConfigError, match="spark-avro"):
        ctas(spark, ONE, database=db, table="t", location=f"{folder}t", format="avro")


@pytest.mark.parametrize(
    "options, message",
    [
        ({"format": "xml"}, "format"),
        ({"save_mode": "append"}, "save_mode"),
        ({"table_mode": "full"}, "table_mode"),
        ({"bucketed_by": ["a"]}, "bucket_count"),
        ({"partitioned_by": "a"}, "list"),
    ],
)
def test_bad_options(spark, db, options, message):
    with pytest.raises(ConfigError, match=message):
        ctas(spark, ONE, database=db, table="t", **options)


def test_generated_name_and_location(spark, db):
    first, second = ctas(spark, ONE, database=db), ctas(spark, TWO, database=db)
    assert first.table != second.table and first.location != second.location
    assert rows(first.frame) + rows(second.frame) == [(1,), (2,)]


def test_table_is_external_without_a_location(spark, db):
    made = ctas(spark, ONE, database=db, table="t")
    spark.sql(f"DROP TABLE {db}.t")
    assert has_objects(spark, made.location)


def test_final_semicolon_and_comment_and_with(spark, db):
    select = "with x as (select 1 as a) select * from x -- all of it\n;"
    assert rows(ctas(spark, select, database=db).frame) == [(1,)]


def test_properties_and_odd_names(spark, db):
    made = ctas(
        spark,
        "select 1 as `odd name`, 2 as `back``tick`, 3 as `key one`",
        database=db,
        table="t",
        partitioned_by=["key one"],
        additional_properties={"owner's": "it's \\ me", "n": "5"},
    )
    assert rows(made.frame) == [(1, 2, 3)]
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {db}.t").collect()}
    assert properties["owner's"] == "it's \\ me" and properties["n"] == "5"


def test_partitioned(spark, db, folder):
    select = "select a, b, cast(c as date) as c from values (1, 'x/y z', '2020-01-01'), (2, null, '2020-01-02') t(a, b, c)"
    made = ctas(spark, select, database=db, table="t", location=f"{folder}t", partitioned_by=["b", "c"])
    assert rows(made.frame) == rows(spark.sql(select))
    assert spark.sql(f"SHOW PARTITIONS {db}.t").count() == 2


def test_bucketed_table_groups_without_a_shuffle(spark, db, sf):
    made = ctas(
        spark, f"select * from parquet.`{sf}/orders.parquet`", database=db, bucketed_by=["o_custkey"], bucket_count=4
    )
    plan = made.frame.groupBy("o_custkey").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert made.frame.count() == spark.read.parquet(f"{sf}/orders.parquet").count()


# --- table modes ---


@pytest.mark.parametrize("options", [{}, {"partitioned_by": ["b"]}, {"bucketed_by": ["b"], "bucket_count": 2}])
def test_empty(spark, db, folder, options):
    select = "select cast(1 as decimal(7, 3)) as a, map('k', 1) as m, 2 as b"
    made = ctas(spark, select, database=db, table="t", location=f"{folder}t", table_mode="empty", **options)
    assert rows(made.frame) == [] and not has_objects(spark, made.location)
    assert made.frame.schema.simpleString() == "struct<a:decimal(7,3),m:map<string,int>,b:int>"
    spark.sql(f"INSERT INTO {db}.t SELECT * FROM ({select})")
    assert spark.table(f"{db}.t").count() == 1


@pytest.mark.parametrize("options", [{}, {"partitioned_by": ["b"]}, {"bucketed_by": ["b"], "bucket_count": 2}])
@pytest.mark.parametrize("location", ["t", None])
def test_data_only(spark, db, folder, options, location):
    select = "select id as a, cast(id % 3 as int) as b from range(9)"
    place = location and f"{folder}{location}"
    made = ctas(spark, select, database=db, table="t", location=place, table_mode="data_only", **options)
    assert rows(made.frame) == rows(spark.sql(select))
    assert has_objects(spark, made.location)
    assert spark.sql(f"SHOW TABLES IN {db}").where("NOT isTemporary").isEmpty()


# --- save modes ---


def make(spark, db, folder, state):
    """Bring about one of: nothing, a table elsewhere, only files, a table with files here."""
    if state in ("table", "both"):
        place = f"{folder}t" if state == "both" else f"{folder}elsewhere"
        ctas(spark, ONE, database=db, table="t", location=place)
    if state == "files":
        spark.sql(ONE).write.parquet(f"{folder}t")


@pytest.mark.parametrize("state", ["nothing", "table", "files", "both"])
@pytest.mark.parametrize("table_mode", ["default", "empty", "data_only"])
def test_overwrite(spark, db, folder, state, table_mode):
    make(spark, db, folder, state)
    made = ctas(spark, TWO, database=db, table="t", location=f"{folder}t", table_mode=table_mode)
    assert rows(made.frame) == ([] if table_mode == "empty" else [(2,)])
    assert spark.catalog.tableExists(f"{db}.t") == (table_mode != "data_only")
    # Only the given location is emptied, not that of the old table.
    assert has_objects(spark, f"{folder}elsewhere") == (state == "table")
    assert tidy(spark, folder, db)


@pytest.mark.parametrize("state", ["table", "files", "both"])
@pytest.mark.parametrize("table_mode", ["default", "empty", "data_only"])
def test_error_if_exists(spark, db, folder, state, table_mode):
    make(spark, db, folder, state)
    options = dict(database=db, table="t", location=f"{folder}t", save_mode="error_if_exists")
    with pytest.raises(AlreadyExists):
        ctas(spark, TWO, table_mode=table_mode, **options)
    assert tidy(spark, folder, db)


@pytest.mark.parametrize("state", ["table", "files", "both"])
def test_ignore(spark, db, folder, state):
    make(spark, db, folder, state)
    held = ctas(spark, TWO, database=db, table="t", location=f"{folder}t", save_mode="ignore")
    assert not held.created and rows(held.frame) == [(1,)]


@pytest.mark.parametrize("save_mode", ["error_if_exists", "ignore", "none"])
def test_nothing_in_the_way(spark, db, folder, save_mode):
    made = ctas(spark, TWO, database=db, table="t", location=f"{folder}t", save_mode=save_mode)
    assert made.created and rows(made.frame) == [(2,)]


@pytest.mark.parametrize("state", ["table", "files", "both"])
def test_none_leaves_it_to_spark(spark, db, folder, state):
    make(spark, db, folder, state)
    with pytest.raises(Exception, match="ALREADY_EXISTS|non-empty|empty"):
        ctas(spark, TWO, database=db, table="t", location=f"{folder}t", save_mode="none")


def test_marker_files_are_no_objects(spark, db, folder):
    ctas(spark, ONE, database=db, table="t", location=f"{folder}t")
    spark.sql(f"DROP TABLE {db}.t")
    for path in spark.read.parquet(f"{folder}t").inputFiles():
        Path(path.removeprefix("file://")).unlink()
    assert not has_objects(spark, f"{folder}t")
    made = ctas(spark, TWO, database=db, table="t", location=f"{folder}t", save_mode="error_if_exists")
    assert rows(made.frame) == [(2,)]


@pytest.mark.parametrize("options", [{}, {"partitioned_by": ["b"]}, {"bucketed_by": ["b"], "bucket_count": 2}])
@pytest.mark.parametrize("same", [True, False])
def test_select_may_read_the_table_it_replaces(spark, db, folder, options, same):
    first = "select id as a, cast(id % 3 as int) as b from range(9)"
    ctas(spark, first, database=db, table="t", location=f"{folder}t", **options)
    place = f"{folder}t" if same else f"{folder}u"
    made = ctas(spark, "select a + 1 as a, b from t", database=db, table="t", location=place, **options)
    assert rows(made.frame) == rows(spark.sql(f"select a + 1 as a, b from ({first})"))
    spark.sql(f"INSERT INTO {db}.t VALUES (100, 100)")
    assert spark.table(f"{db}.t").count() == 10
    assert tidy(spark, folder, db)


@pytest.mark.parametrize("place", ["t", "u"])
@pytest.mark.parametrize("select", ["select 1 / (id - id) as a from range(3)", "select nowhere"])
def test_failing_select_leaves_the_old_table(spark, db, folder, place, select):
    ctas(spark, ONE, database=db, table="t", location=f"{folder}t")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|UNRESOLVED"):
        ctas(spark, select, database=db, table="t", location=f"{folder}{place}")
    assert rows(spark.table(f"{db}.t")) == [(1,)]
    assert tidy(spark, folder, db)


def test_timeout(spark, db, folder):
    with pytest.raises(QueryTimeout):
        ctas(
            spark,
            "select sum(hash(id) % 7) as s from range(100000000000)",
            database=db,
            location=f"{folder}t",
            timeout=timedelta(seconds=1),
        )
    assert tidy(spark, folder, db)


@pytest.mark.parametrize("filled", [True, False])
@pytest.mark.parametrize("table_mode", ["default", "data_only"])
def test_managed_table_at_the_same_place(spark, db, folder, filled, table_mode):
    spark.sql(f"CREATE TABLE {db}.t (a INT) USING parquet")
    if filled:
        spark.sql(f"INSERT INTO {db}.t VALUES (1)")
    place = spark.sql(f"DESCRIBE DATABASE {db}").where("info_name = 'Location'").first()[1] + "/t"
    made = ctas(spark, TWO, database=db, table="t", location=place, table_mode=table_mode)
    assert rows(made.frame) == [(2,)]


def test_view_of_the_same_name(spark, db, folder):
    spark.sql(f"CREATE VIEW {db}.t AS SELECT 1 AS a")
    assert rows(ctas(spark, TWO, database=db, table="t", location=f"{folder}t").frame) == [(2,)]


def tidy(spark, folder, db):
    """No scratch table, staging directory or temporary view is left over."""
    names = [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()]
    staged = [p for p in Path(folder.removeprefix("file:")).rglob("_*") if p.name.startswith(("_stag", "_repl"))]
    return not staged and not [n for n in names if n.startswith(("scratch_", "select_"))]


# --- what a SELECT may be ---


def test_partitioned_and_bucketed(spark, db, folder):
    select = "select id as a, cast(id % 3 as int) as b, cast(id % 5 as int) as c from range(300)"
    options = dict(partitioned_by=["B"], bucketed_by=["a"], bucket_count=4)
    for _ in range(2):
        made = ctas(spark, select, database=db, table="t", location=f"{folder}t", **options)
        assert rows(made.frame, "a", "b", "c") == rows(spark.sql(select))
    assert spark.sql(f"SHOW PARTITIONS {db}.t").count() == 3
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {db}.t").collect()}
    assert detail["Num Buckets"] == "4"


@pytest.mark.parametrize("columns", [["a"], ["nowhere"], ["a", "a"]])
def test_impossible_partitions(spark, db, folder, columns):
    ctas(spark, ONE, database=db, table="t", location=f"{folder}t")
    with pytest.raises(Exception, match="PARTITION|partition|UNRESOLVED|COLUMN"):
        ctas(spark, TWO, database=db, table="t", location=f"{folder}t", partitioned_by=columns)
    assert rows(spark.table(f"{db}.t")) == [(1,)] and tidy(spark, folder, db)


@pytest.mark.parametrize(
    "select",
    [
        "select id as a from mine order by id desc",
        "select id as a from mine limit 3",
        "select max(id) as a from mine",
        "select id as a from mine union all select id from mine",
        "values (1L), (2L) as t(a)",
        "with x as (select * from mine) select x.id as a from x join mine using (id)",
        "select explode(sequence(1L, 3L)) as a",
        "select id as a from mine where id = :n",
    ],
)
@pytest.mark.parametrize("options", [{}, {"rebalance": True}, {"bucketed_by": ["a"], "bucket_count": 2}])
def test_selects_of_all_kinds(spark, db, folder, select, options):
    spark.range(7).createOrReplaceTempView("mine")
    args = {"n": 5} if ":n" in select else None
    made = ctas(spark, select, database=db, table="t", location=f"{folder}t", args=args, **options)
    assert made.frame.count() == spark.sql(select, args=args).count()
    assert tidy(spark, folder, db)


def test_not_a_select(spark, db, folder):
    with pytest.raises(Exception):
        ctas(spark, "selct 1", database=db, table="t", location=f"{folder}t")
    assert not spark.catalog.tableExists(f"{db}.t") and tidy(spark, folder, db)
