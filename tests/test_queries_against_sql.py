"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from check_oracle import compare, connect
from sparkloom import registry

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query(key, spark, sf_dir, con):
    df = QUERIES[key](spark, sf_dir)
    assert key in ORACLES
    assert compare(con, ORACLES[key], df) is None


def test_entry_gives_rows(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and [r.n for r in rows] == sorted((r.n for r in rows), reverse=True)
