"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tenderlake.catalog import QUERIES
from tools.compare import compare, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    text, _, same = compare(spark, oracle, name, SF_DIR)
    assert same, text


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["category", "region", "count", "total_value", "avg_value", "max_value",
                                          "min_value"]
