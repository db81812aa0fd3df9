"""Every registered query against its SQL on the whole tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import check, connect
from tallyroll.plans.catalogue import catalogue
from tallyroll.plans.reference_sql import reference_sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalogue()) == set(reference_sql())


@pytest.mark.parametrize("name", sorted(catalogue()))
def test_query(spark, con, name):
    assert check(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name]) > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["category", "product_ID", "revenue_prod_byCat"]
