"""Every registered query against its SQL on the small tables."""

import inspect
import os

import pytest
from oracle import compare, connect

import __spark_entry__ as driver
from workloads import QUERIES, SQL

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_contract(spark):
    assert QUERIES.keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()
    assert driver.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert name in SQL, "every query here can be put in SQL"
    assert list(inspect.signature(QUERIES[name]).parameters)[:2] == ["spark", "folder"]
    assert compare(spark, con, QUERIES[name], SQL[name], FOLDER) == []
