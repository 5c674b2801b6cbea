"""Every query against its SQL on the same tables; queries without SQL must give rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare, connect  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from corvane.plans import load_all  # noqa: E402

# The optional subpackage brings its own tests.
QUERIES = {name: run for name, run in entry_module.queries().items() if name in load_all()}
SQL = {name: sql for name, sql in entry_module.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        assert compare(df, con, SQL[name]) == []
    else:
        assert not df.isEmpty()


def test_entry(spark):
    out = entry_module.entry(spark)
    assert out.columns == ["doc_id", "n_chunks", "mean_length"]
    assert out.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
