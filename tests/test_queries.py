"""Every registered query against its SQL, in values, column names and types."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from tillrecon.plans.table_oracles import ORACLES
from tillrecon.plans.table_queries import QUERIES

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert oracle.compare(df, connection, entry.oracle_sql()[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
