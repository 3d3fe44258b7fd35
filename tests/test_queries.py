"""Every registered query against its SQL counterpart, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from wavemill.queries import model, oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = {name: model.build(name) for name in model.QUERIES}, oracle.statements()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLE[name], FOLDER) == ""


def test_the_driver_gets_them_all():
    assert QUERIES.keys() <= entry.queries().keys() and ORACLE.keys() <= entry.oracle_sql().keys()


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["survey_cycle", "cycle_order"] and df.count() == 3
