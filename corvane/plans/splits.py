"""Sort, head, sample and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators import splits as sp
from corvane.plans import query


@query("l1_sort_by_latest", """
    SELECT o_custkey, max(year(o_orderdate))::INT AS latest FROM orders GROUP BY o_custkey ORDER BY latest DESC, o_custkey""")
def l1(t):
    years = t("orders").groupBy("o_custkey").agg(F.collect_set(F.year("o_orderdate")).alias("years"))
    return sp.sort_by_latest(years, "years", "o_custkey").select("o_custkey", F.array_max("years").alias("latest"))


@query("l2_sort_by_distance", """
    SELECT s_suppkey, abs(s_acctbal) AS dist FROM supplier ORDER BY dist, s_suppkey""")
def l2(t):
    return t("supplier").select("s_suppkey", F.abs("s_acctbal").alias("dist")).orderBy("dist", "s_suppkey")


@query("l3_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500")
def l3(t):
    return sp.head(t("orders").select("o_orderkey", "o_totalprice"), 500, [F.desc("o_totalprice"), "o_orderkey"])


@query("l4_sample_n", """
    SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || ':7'), doc_id LIMIT 100""")
def l4(t):
    return sp.sample_n(t("documents").select("doc_id", "lang"), 100, 7, ["doc_id"])


def _test_sql(table: str, key: str, frac: float, seed: int) -> str:
    return f"""(SELECT {key} FROM (SELECT {key}, row_number() OVER (ORDER BY md5({key} || ':{seed}')) AS r,
        count(*) OVER () AS n FROM (SELECT DISTINCT {key} FROM {table})) WHERE r <= ceil(n * {frac}::DOUBLE))"""


def _sides(pair):
    train, test = pair
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


for _frac, _seed in ((0.05, 1234), (0.1, 1), (0.2, 33)):
    query(f"l5_split_{int(_frac * 100):02d}", f"""
        SELECT doc_id, CASE WHEN doc_id IN {_test_sql('documents', 'doc_id', _frac, _seed)}
               THEN 'test' ELSE 'train' END AS side FROM documents""")(
        lambda t, f=_frac, s=_seed: _sides(sp.split(t("documents").select("doc_id"), f, s, ["doc_id"])))


@query("l6_tail_split", """
    SELECT o_orderkey, CASE WHEN r <= floor(n * 0.7::DOUBLE) THEN 'train' ELSE 'validation' END AS side
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r, count(*) OVER () AS n FROM orders)""")
def l6(t):
    train, val = sp.tail_split(t("orders").select("o_orderkey"), 0.3, "o_orderkey")
    return train.withColumn("side", F.lit("train")).unionByName(val.withColumn("side", F.lit("validation")))


@query("l7_group_split", f"""
    SELECT event_id, user_id, CASE WHEN user_id IN {_test_sql('events', 'user_id', 0.1, 5)}
           THEN 'test' ELSE 'train' END AS side FROM events""")
def l7(t):
    return _sides(sp.group_split(t("events").select("event_id", "user_id"), 0.1, 5, ["user_id"]))
