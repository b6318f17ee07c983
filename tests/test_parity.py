"""Every query next to its SQL, over the smallest of the given data sets."""

import pytest

import __spark_entry__ as entry_points
from parity.compare import connect, differences
from parity.oracle import ORACLE
from parity.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_all_are_registered():
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLE.items() <= entry_points.oracle_sql().items()


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 11 and sum(row.snapshots for row in rows) == 934


@pytest.mark.parametrize("name", QUERIES)
def test_rows_match(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, ORACLE[name]) == []
