"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from ledgerline.catalog import ORACLES, QUERIES
from oracle import compare, duck

from conftest import SF_SMALL

_con = None


def con():
    global _con
    if _con is None:
        _con = duck(SF_SMALL)
    return _con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert compare(df, con(), ORACLES[name]) == []


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())
