"""Exact nearest-vector search and prompt context."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.operators.nearest import Best, matrix
from corvane.operators.vector_index import QUERY_VALUES, VectorIndex
from corvane.scale import limit, lookup_join, materialize


def top_k(queries: DataFrame, corpus: DataFrame, k: int = 10, metric: str = "cosine",
          qid: str = "qid", cid: str = "id", vector: str = "vector",
          query_values: int | None = None, block_values: int | None = None) -> DataFrame:
    """The k corpus rows nearest to each query: (qid, id, score, rank).

    ``cosine`` scores are similarities, ``l2`` scores squared distances. Each task
    scans its corpus rows once against the query matrix and emits k rows per query,
    so no pair is materialised and the corpus is not shuffled. For a query set above
    ``query_values`` numbers the corpus is written once as a :class:`VectorIndex`
    (cells fitted on ``block_values`` numbers), which blocks of queries then search in
    place. Both ways are exact. To search a corpus again, build the index and keep it.
    """
    query_values = limit(corpus.sparkSession, "queryValues", QUERY_VALUES, query_values)
    schema = f"__q {queries.schema[qid].dataType.simpleString()}, __id {corpus.schema[cid].dataType.simpleString()}, __s double"
    q = queries.select(F.col(qid).alias("__q"), F.col(vector).alias("__v")).filter("__v is not null")
    q = materialize(q, "queries")
    shape = q.agg(F.count("*").alias("n"), F.max(F.size("__v")).alias("d")).first()
    dim = shape["d"] or 1
    if shape["n"] * dim > query_values:
        index = VectorIndex.build(corpus, metric, cid, vector, sample_values=block_values)
        return _named(index.search(q, k, "__q", "__v", query_values), metric, qid, cid)
    held = q.toPandas()
    qids = held["__q"].to_numpy()
    mat = matrix(held["__v"]) if len(held) else np.empty((0, dim))
    shared = queries.sparkSession.sparkContext.broadcast((qids, mat))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, mat = shared.value
        best = Best(ids, k)
        for pdf in batches:
            pdf = pdf[pdf["__v"].notna()]
            if len(pdf) and len(ids):
                best.offer(np.arange(len(ids)), mat, pdf["__id"].to_numpy(), matrix(pdf["__v"]), metric)
        yield best.frame()

    near = corpus.select(F.col(cid).alias("__id"), F.col(vector).alias("__v")).mapInPandas(scan, schema)
    w = Window.partitionBy("__q").orderBy(F.desc("__s"), "__id")
    ranked = near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return _named(ranked, metric, qid, cid)


def _named(hits: DataFrame, metric: str, qid: str, cid: str) -> DataFrame:
    score = F.col("__s") if metric == "cosine" else 0.0 - F.col("__s")
    return hits.select(F.col("__q").alias(qid), F.col("__id").alias(cid), score.alias("score"), "rank")


def search(index: VectorIndex, queries: DataFrame, k: int = 10, qid: str = "qid", cid: str = "id",
           vector: str = "vector") -> DataFrame:
    """:func:`top_k` against a stored index; columns and values are the same."""
    return _named(index.search(queries, k, qid, vector), index.metric, qid, cid)


def knn(probes: DataFrame, points: DataFrame, k: int = 3, x: str = "x", y: str = "y",
        id_: str = "id") -> DataFrame:
    """The k nearest other points of each probe point: (qid, id, dist, rank)."""
    vec = F.array(F.col(x).cast("double"), F.col(y).cast("double")).alias("vector")
    hits = top_k(probes.select(F.col(id_).alias("qid"), vec), points.select(F.col(id_).alias("id"), vec),
                 k + 1, "l2")
    w = Window.partitionBy("qid").orderBy("rank")
    others = hits.filter("qid <> id").withColumn("rank", F.row_number().over(w))
    return others.filter(F.col("rank") <= k).select("qid", "id", F.sqrt("score").alias("dist"), "rank")


def mean_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean vector per key; items are averaged by position with map-side combine."""
    means = (df.select(key, F.posexplode(vector).alias("pos", "v"))
             .groupBy(key, "pos").agg(F.avg(F.col("v").cast("double")).alias("v")))
    items = F.array_sort(F.collect_list(F.struct("pos", "v")))
    return means.groupBy(key).agg(F.transform(items, lambda x: x["v"]).alias("vector"))


def attach_context(hits: DataFrame, docs: DataFrame, cid: str = "id", qid: str = "qid",
                   text: str = "text", sep: str = "\n\n") -> DataFrame:
    """Texts of the hits of each question, joined in rank order; a group has k rows.

    The hits go to the texts: their ids are broadcast while they fit, so the texts stay in
    place, and only the texts found meet the hits again.
    """
    hits = materialize(hits, "hits")
    texts = lookup_join(docs.select(cid, text), hits.select(cid).distinct(), [cid], "left_semi")
    found = hits.join(texts, cid)
    items = F.array_sort(F.collect_list(F.struct("rank", text)))
    return found.groupBy(qid).agg(F.count("*").alias("n_hits"),
                                  F.array_join(F.transform(items, lambda x: x[text]), sep).alias("context"))
