"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from conftest import FOLDER

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 7 and all(row.tagged >= 0 for row in rows)


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(frame, con, ORACLES[name]) is None
    else:
        assert frame.count() > 0
