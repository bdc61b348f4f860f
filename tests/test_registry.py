"""Every registered query against its SQL counterpart on the smallest benchmark tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lonja.testbed import oracle, queries as registry
from check import compare, database

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables here")


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(oracle.oracle_sql()) == set(registry.queries())


def test_the_driver_sees_every_query():
    assert set(registry.queries()) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, connection, name):
    verdict, _ = compare(spark, connection, SF_DIR, name)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry(spark).count() > 0
