"""Registered queries against their SQL counterparts, over whole tables."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from stratalake.plans.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql_engine():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    assert len(contract.entry(spark).take(1)) == 1


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, sql_engine, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert difference(df, sql_engine, contract.oracle_sql()[name]) == ""
