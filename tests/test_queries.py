"""Every registered query against its SQL on the smallest sample tables."""

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from ledgerproof.plans.oracles import ORACLES
from ledgerproof.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["cnt", "sum_total_cashout_usd", "sum_tms_usd_amount", "sum_diff_usd"]
    assert df.count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, _, message = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert ok, message
