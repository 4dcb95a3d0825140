"""Every registered query runs; those with a SQL counterpart agree with it."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_counterpart_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", driver.queries())
def test_query(spark, tables, name):
    df = driver.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = Counter(tuple(tuple(x) if isinstance(x, list) else x for x in row) for row in df.select(columns).collect())
    assert found
    if name in driver.oracle_sql():
        expected = tables.execute(driver.oracle_sql()[name])
        names = [column[0] for column in expected.description]
        assert sorted(names) == columns
        order = [names.index(column) for column in columns]
        assert found == Counter(tuple(row[at] for at in order) for row in expected.fetchall())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
