import os
import tempfile
import uuid

import pytest
from pyspark import SparkConf
from pyspark.sql import SparkSession

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    # Failed tasks are tried three times, as on a cluster.
    builder = (
        SparkSession.builder.master("local[8, 3]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    )
    if not SparkConf().contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A directory of the test's own, as a URI ending in a slash."""
    return f"file:{tmp_path}/"


@pytest.fixture
def db(spark, folder):
    name = f"db_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}{name}'")
    return name


@pytest.fixture
def sf():
    return SF


# Nations of two regions: their number, then the keys of the partition they are in.
AMERICA, EUROPE = (5, 1, 7), (5, 3, 6)


@pytest.fixture
def small(spark, db, folder):
    """A table of two partitions by int keys: how many nations a region has, by its number and the length of its name."""
    from partloom import ctas

    ctas(
        spark,
        "SELECT CAST(count(*) AS INT) AS a, r_regionkey AS b, length(r_name) AS c FROM parquet.`${sf}/region.parquet` "
        "JOIN parquet.`${sf}/nation.parquet` ON n_regionkey = r_regionkey WHERE r_regionkey IN (1, 3) GROUP BY r_regionkey, r_name",
        params={"sf": SF},
        database=db,
        table="small",
        location=f"{folder}small",
        partitioned_by=["b", "c"],
    )
    return "small"


def rows(frame, *columns):
    """The rows as sorted tuples."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)
