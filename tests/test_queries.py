"""Every registered query against DuckDB on the same tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"create view {file.split('.')[0]} as select * from '{SF_DIR}/{file}'")
    return connection


# The training-data queries have tests of their own.
NAMES = sorted(set(contract.queries()) - set(contract.LLM_QUERIES))


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    answer = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    wanted = Counter(tuple(dict(zip(names, row))[c] for c in columns) for row in answer.fetchall())
    assert Counter(tuple(row) for row in got.select(*columns).collect()) == wanted


def test_entry(spark):
    assert contract.entry(spark).count() > 0
