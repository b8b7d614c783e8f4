"""Every registered query equals its SQL, run by another engine on the same files."""

import os
from decimal import Decimal

import duckdb
import pytest
from conftest import SF

from __spark_entry__ import entry, oracle_sql, queries
from workloads import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(SF, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def comparable(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(float(row[i]) if isinstance(row[i], Decimal) else row[i] for i in order) for row in found), key=repr
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, oracle, name):
    frame = queries()[name](spark, SF)
    expected = oracle.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    assert sorted(frame.columns) == sorted(columns)
    found = comparable(frame.columns, frame.collect())
    assert found and found == comparable(columns, expected.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 1500


def test_every_query_has_its_sql():
    # Those of the training-data operators are held against plain Python where SQL cannot say them.
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
