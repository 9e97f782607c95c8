"""Every registered query against its checking SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in CHECKS:
        assert differences(df, con, CHECKS[name]) == []
    else:
        assert df.count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
