"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from kerbside.plans.oracles import ORACLES
from kerbside.plans.queries import QUERIES
from check_oracles import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
