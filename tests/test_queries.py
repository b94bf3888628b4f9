"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
import workload
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(workload.QUERIES) == set(workload.ORACLES) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    assert difference(df, duck, ORACLES[name]) is None


def test_entry(spark):
    (row,) = contract.entry(spark).collect()
    assert row["_quarantine_reason"] == "unparseable:value" and row["n_rows"] > 0
