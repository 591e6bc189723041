from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallystream.plans.catalog import QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_matches_sql(spark, sf_dir, con, key):
    df = queries()[key](spark, sf_dir)
    compare(df, con, oracle_sql()[key])


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["window_start", "country", "n", "rk"]
