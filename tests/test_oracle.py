"""Every registered query against its SQL oracle on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query(spark, con, name):
    answer, sql = entry.queries()[name], entry.oracle_sql().get(name)
    result = compare(spark, con, FOLDER, name, answer, sql)
    assert result.startswith("ok") and "TYPES" not in result, result


def test_entry_has_rows_and_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.schema == entry.entry(spark).schema
