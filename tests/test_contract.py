"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as contract
import oracle
from rollcall.plans import supplier_oracle, supplier_panel

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(supplier_panel.QUERIES) == set(supplier_oracle.SQL)
    assert set(supplier_panel.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(supplier_panel.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert oracle.compare(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) is None
