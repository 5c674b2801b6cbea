"""The vector index finds what a full scan finds, reads less, and moves no corpus row to do so."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import retrieval as rt
from corvane.operators.vector_index import VectorIndex


def rows(df):
    return sorted(tuple(r) for r in df.withColumn("score", F.round("score", 9)).collect())


def grouped(spark, n=900, dim=8, seed=5):
    """Vectors around 30 centres; a third of them are one vector, some are zero."""
    rng = np.random.default_rng(seed)
    vecs = rng.normal(size=(30, dim))[rng.integers(0, 30, n)] * 4 + rng.normal(size=(n, dim)) * 0.2
    vecs[n // 3:2 * n // 3] = vecs[0]
    vecs[[5, n - 1]] = 0
    data = [(i, v.tolist()) for i, v in enumerate(vecs)]
    return spark.createDataFrame(data + [(n, None)], "id long, vector array<double>").repartition(6)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_equals_a_scan(spark, metric):
    corpus = grouped(spark)
    queries = corpus.filter("id % 9 = 5").withColumnRenamed("id", "qid")
    want = rows(rt.top_k(queries, corpus, 7, metric))
    index = VectorIndex.build(corpus, metric)
    assert rows(rt.search(index, queries, 7)) == want
    reopened = VectorIndex.open(spark, index.path)
    _, report = reopened.search_reported(queries.filter("qid <> 5"), 7)
    assert reopened.metric == metric and report.cells > 15
    assert report.cell_share < 0.5
    blocks, _ = reopened.search_reported(queries, 7, query_values=8 * 30)
    assert rows(blocks.selectExpr("__q qid", "__id id", "__s score", "rank")) == rows(
        reopened.search(queries, 7).selectExpr("__q qid", "__id id", "__s score", "rank"))


def test_more_hits_than_rows_and_empty_sides(spark):
    corpus = grouped(spark, 40)
    queries = corpus.limit(3).withColumnRenamed("id", "qid")
    index = VectorIndex.build(corpus, "l2")
    assert rows(rt.search(index, queries, 100)) == rows(rt.top_k(queries, corpus, 100, "l2"))
    assert rt.search(index, queries.limit(0)).count() == 0
    empty = VectorIndex.build(corpus.limit(0), "cosine")
    assert rt.search(empty, queries).count() == 0


def test_text_ids(spark):
    corpus = grouped(spark, 60).withColumn("id", F.format_string("v%03d", "id"))
    queries = corpus.limit(9).withColumnRenamed("id", "qid")
    assert rows(rt.search(VectorIndex.build(corpus, "l2"), queries, 4)) == rows(rt.top_k(queries, corpus, 4, "l2"))


def test_a_search_shuffles_hits_only(spark):
    corpus = grouped(spark)
    index = VectorIndex.build(corpus, "l2")
    held = np.array([r["vector"] for r in corpus.filter("id in (0, 8)").collect()])
    wanted = np.zeros((2, len(index.cells)), bool)
    wanted[0, :2] = True
    plan = index._scan(np.array([0, 8]), held, wanted, 3, "__q bigint, __id bigint, __s double") \
        ._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInPandas"):]
    assert "Exchange" not in below and "PartitionFilters: [cell" in below.replace("isnotnull(cell", "cell")


def test_context_leaves_the_texts_in_place(spark):
    docs = spark.range(500).select("id", F.concat(F.lit("t"), "id").alias("text"))
    hits = spark.createDataFrame([(1, 7, 1), (1, 3, 2), (2, 7, 1), (2, 999, 2)], "qid int, id bigint, rank int")
    got = rt.attach_context(hits, docs)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2, "t7\n\nt3"), (2, 1, "t7")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin LeftSemi" not in plan and "BroadcastHashJoin" in plan
