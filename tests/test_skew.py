"""Queries on tables where one key holds a third of all rows, with limits low enough that
every hot-key path is taken; the results must still equal the SQL."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import TABLES, compare, connect  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from corvane.plans import load_all  # noqa: E402

QUERIES = {name: run for name, run in entry_module.queries().items() if name in load_all()}
SQL = entry_module.oracle_sql()
LIMITS = {"rowsPerTask": 60, "broadcastRows": 8, "queryValues": 200, "blockValues": 2000, "sampleRows": 10}
PREFIXES = ("w", "g", "j", "l4", "l5_split_05", "l6", "l7", "a6_batches", "a9_auc", "a20", "a21", "a23_td_error", "t11_apply",
            "t13", "t14", "t16", "t18", "t1_chunk_lookback_256", "t5", "s10", "u3")
NAMES = [n for n in sorted(QUERIES) if n in SQL and n.startswith(PREFIXES)]

REPLACED = {
    "customer": "CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE c_nationkey END AS c_nationkey",
    "supplier": "CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE s_nationkey END AS s_nationkey",
    "part": "CASE WHEN p_partkey % 3 = 0 THEN 'Brand#1' ELSE p_brand END AS p_brand",
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey",
    "events": "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id",
    "embeddings": "CASE WHEN vec_id % 3 = 0 THEN 0 ELSE label END AS label",
}


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    src, dst = "/root/testdata/sf0.001", str(tmp_path_factory.mktemp("skewed"))
    con = duckdb.connect()
    special = {
        "lineitem": f"""SELECT CASE WHEN r % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey,
            CASE WHEN r % 3 = 1 THEN 7 ELSE l_partkey END AS l_partkey, CASE WHEN r % 3 = 1 THEN 3 ELSE l_suppkey END AS l_suppkey,
            CASE WHEN r % 3 = 0 THEN 1000 + r ELSE l_linenumber END::INT AS l_linenumber,
            * EXCLUDE (l_orderkey, l_partkey, l_suppkey, l_linenumber, r)
            FROM (SELECT *, row_number() OVER () AS r FROM '{src}/lineitem.parquet')""",
        "conversations": f"""SELECT c AS conv_id, row_number() OVER (PARTITION BY c ORDER BY conv_id, turn) - 1 AS turn, role, text
            FROM (SELECT *, CASE WHEN conv_id % 3 = 0 THEN 12 ELSE conv_id END AS c FROM '{src}/conversations.parquet')""",
        "documents": f"""SELECT doc_id, CASE WHEN doc_id = 9 THEN big ELSE text END AS text, lang, source,
            CASE WHEN doc_id = 9 THEN length(big) ELSE n_chars END::BIGINT AS n_chars
            FROM '{src}/documents.parquet', (SELECT string_agg(text, chr(10) ORDER BY doc_id) AS big
              FROM '{src}/documents.parquet' WHERE doc_id % 3 = 0)""",
    }
    for name in TABLES:
        body = special.get(name) or f"SELECT * REPLACE ({REPLACED[name]}) FROM '{src}/{name}.parquet'" \
            if name in special or name in REPLACED else f"SELECT * FROM '{src}/{name}.parquet'"
        con.execute(f"COPY ({body}) TO '{dst}/{name}.parquet'")
    return dst


@pytest.fixture(scope="module")
def tight(spark):
    for name, value in LIMITS.items():
        spark.conf.set(f"spark.corvane.{name}", value)
    yield spark
    for name in LIMITS:
        spark.conf.unset(f"spark.corvane.{name}")


@pytest.fixture(scope="module")
def con(skewed_dir):
    return connect(skewed_dir)


@pytest.mark.parametrize("name", NAMES)
def test_skewed(tight, skewed_dir, con, name):
    problems = compare(QUERIES[name](tight, skewed_dir), con, SQL[name])
    assert problems in ([], ["both sides are empty"])
