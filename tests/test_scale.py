"""The paths taken for hot keys and large tables give what the simple paths give."""

import random

import pytest
from pyspark.sql import functions as F

from corvane import scale
from corvane.operators import retrieval as rt
from corvane.operators import sequences as sq
from corvane.operators import splits as sp


def rows(df):
    return sorted(map(repr, (r.asDict() for r in df.collect())))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on one key, one null key, many small keys."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randrange(40)}")
        data.append((key, rng.randrange(500), i, rng.choice("abc")))
    return spark.createDataFrame(data, "k string, t int, id int, v string").repartition(7).cache()


def build(df, limit):
    seq = scale.Ordered(df, ["k"], ["t", "id"], limit)
    out = (seq.index("ix").lag(prev="v", prev_id="id").lead(nxt="v")
           .running(upto=(F.col("v") == "a").cast("bigint"))
           .running(inclusive=False, before=F.lit(1).cast("bigint")).result())
    return seq.split, out


def test_split_sequences_equal_plain_windows(skewed):
    plain, want = build(skewed, 10 ** 9)
    cut, got = build(skewed, 50)
    assert (plain, cut) == (False, True)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows(got) == rows(want)


@pytest.mark.parametrize("limit", [50, 10 ** 9])
def test_global_index(skewed, limit):
    got = scale.global_index(skewed, ["t", "id"], "ix", limit).orderBy("t", "id").collect()
    assert [r["ix"] for r in got] == list(range(3000))


def test_sequence_operators_when_split(skewed):
    for fn in (lambda n: sq.dedup_adjacent(skewed, ["k"], ["t", "id"], "v", n),
               lambda n: sq.take_until_repeat(skewed, ["k"], ["t", "id"], "v", n),
               lambda n: sq.turn_index(skewed, ["k"], ["t", "id"], rows_per_task=n),
               lambda n: sq.trajectory(skewed, ["k"], ["t", "id"], "v", ["a", "b", "c"], True, rows_per_task=n)):
        assert rows(fn(40)) == rows(fn(10 ** 9))


def test_lookup_join_paths_agree(spark, skewed):
    dims = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("none", 4)], "k string, d int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = rows(skewed.join(dims, ["k"], how))
        assert rows(scale.lookup_join(skewed, dims, ["k"], how)) == want
        assert rows(scale.lookup_join(skewed, dims, ["k"], how, broadcast_rows=1, rows_per_task=100)) == want
        assert rows(scale.lookup_join(skewed, dims, ["k"], how, broadcast_rows=1)) == want
        assert rows(scale.lookup_join(skewed, dims, ["k"], how, broadcast_bytes=1, rows_per_task=100)) == want


@pytest.mark.parametrize("values", [list(range(1, 200)), [5] * 30 + [7] * 3, [-2 ** 40, 0, 3, 2 ** 59], [9]])
def test_nth_smallest(spark, values, monkeypatch):
    monkeypatch.setattr(scale, "_COLLECT_ROWS", 4)
    monkeypatch.setattr(scale, "_BUCKETS", 8)
    df = spark.createDataFrame([(v,) for v in values], "k long")
    for n in {1, len(values) // 2 + 1, len(values)}:
        want = sorted(values)[n - 1]
        assert scale.nth_smallest(df, "k", n) == (want, sum(v < want for v in values))
    with pytest.raises(ValueError):
        scale.nth_smallest(df, "k", len(values) + 1)


def test_splits_are_exact_and_disjoint(spark):
    df = spark.range(1003)
    for frac, want in ((0.05, 51), (0.1, 101), (0.2, 201), (0.0, 0), (1.0, 1003)):
        train, test = sp.split(df, frac, 1234, ["id"])
        a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
        assert len(b) == want and not a & b and len(a | b) == 1003
    assert {r[0] for r in sp.split(df.repartition(3), 0.1, 1, ["id"])[1].collect()} == \
        {r[0] for r in sp.split(df, 0.1, 1, ["id"])[1].collect()}


def test_split_with_equal_hashes(spark, monkeypatch):
    monkeypatch.setattr(sp, "hash_key", lambda *key, seed: F.lit(5).cast("bigint"))
    train, test = sp.split(spark.range(10), 0.25, 1, ["id"])
    assert sorted(r[0] for r in test.collect()) == [0, 1, 2] and train.count() == 7


def test_sample_sizes(spark, monkeypatch):
    df = spark.range(500)
    heap = {r[0] for r in sp.sample_n(df, 60, 3, ["id"]).collect()}
    monkeypatch.setattr(sp, "SAMPLE_ROWS", 10)
    assert {r[0] for r in sp.sample_n(df, 60, 3, ["id"]).collect()} == heap and len(heap) == 60
    assert sp.sample_n(df, 900, 3, ["id"]).count() == 500


def test_group_split_keeps_groups(spark, skewed):
    train, test = sp.group_split(skewed.filter("k is not null"), 0.3, 5, ["k"])
    a, b = {r["k"] for r in train.collect()}, {r["k"] for r in test.collect()}
    assert not a & b and len(b) == -(-len(a | b) * 3 // 10)


def test_tail_split(spark):
    train, val = sp.tail_split(spark.range(10).repartition(4), 0.3, "id")
    assert sorted(r[0] for r in val.collect()) == [7, 8, 9] and train.count() == 7


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_top_k_grid_equals_scan_and_brute_force(spark, metric):
    import numpy as np
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(120, 6)).round(1)
    vecs[40:80] = vecs[0]                      # a third of the corpus is one vector
    vecs[90] = 0
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "id long, vector array<double>").repartition(5)
    queries = corpus.filter("id % 11 = 0").withColumnRenamed("id", "qid")
    scan = rows(rt.top_k(queries, corpus, 10, metric).withColumn("score", F.round("score", 9)))
    grid = rows(rt.top_k(queries, corpus, 10, metric, query_values=20, block_values=90).withColumn("score", F.round("score", 9)))
    assert scan == grid

    def score(a, b):
        if metric == "l2":
            return ((a - b) ** 2).sum()
        n = np.linalg.norm(a) * np.linalg.norm(b)
        return -(a @ b) / n if n else 0.0

    got = {}
    for r in rt.top_k(queries, corpus, 10, metric).collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["id"]))
    for q, hits in got.items():
        want = sorted((round(score(vecs[q], v), 9), i) for i, v in enumerate(vecs))[:10]
        assert [i for _, i in sorted(hits)] == [i for _, i in want]


def test_recent_window(spark):
    df = spark.createDataFrame([(1, i, f"m{i}") for i in range(6)] + [(2, 0, "x")], "c int, p int, m string").repartition(3)
    got = {(r["c"], r["p"]): [x["m"] for x in r["history"]] for r in sq.recent(df, ["c"], ["p"], 2, ["m"]).collect()}
    assert got == {(1, i): [f"m{j}" for j in range(max(0, i - 2), i)] for i in range(6)} | {(2, 0): []}
    with_self = {(r["c"], r["p"]): [x["m"] for x in r["history"]] for r in sq.recent(df, ["c"], ["p"], 2, ["m"], True).collect()}
    assert with_self == {(1, i): [f"m{j}" for j in range(max(0, i - 1), i + 1)] for i in range(6)} | {(2, 0): ["x"]}


@pytest.mark.parametrize("last,include_self", [(1, False), (1, True), (7, False), (7, True), (40, False)])
def test_recent_window_when_split(skewed, last, include_self):
    got = sq.recent(skewed, ["k"], ["t", "id"], last, ["id", "v"], include_self, rows_per_task=25)
    want = sq.recent(skewed, ["k"], ["t", "id"], last, ["id", "v"], include_self)
    assert rows(got) == rows(want)


def test_prefix_limits_before_the_shuffle(spark, skewed):
    plan = sq.prefix(skewed, ["k"], ["t", "id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_search_in_small_score_blocks(monkeypatch):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(1)
    vecs = rng.normal(size=(60, 4)).round(1)
    batches = [pd.DataFrame({"__id": range(i, i + 20), "__v": list(vecs[i:i + 20])}) for i in (0, 20, 40)]
    whole = rt._search(iter(batches), np.arange(9), vecs[:9], 5, "l2")
    monkeypatch.setattr(rt, "SCORE_VALUES", 40)
    assert rt._search(iter(batches), np.arange(9), vecs[:9], 5, "l2").equals(whole)
    for q in range(9):
        want = sorted((((vecs[q] - v) ** 2).sum().round(9), i) for i, v in enumerate(vecs))[:5]
        assert list(whole[whole["__q"] == q]["__id"]) == [i for _, i in want]


def test_nulls_give_the_same_on_both_paths(spark):
    rows = [("k", i, None if i % 3 else i) for i in range(40)] + [("z", i, None) for i in range(12)] + [(None, i, 1) for i in range(9)]
    df = spark.createDataFrame(rows, "k string, i long, v long")

    def run(rows_per_task):
        o = scale.Ordered(df, ["k"], ["i"], rows_per_task).running(total=F.col("v")).running(inclusive=False, before=F.col("v"))
        return sorted(map(str, o.result().collect()))
    assert run(5) == run(1000)


def test_global_index_keeps_rows_without_an_order_value(spark):
    df = spark.createDataFrame([(None, "a"), (3, "b"), (1, "c")], "o long, v string")
    assert {r["v"]: r["ix"] for r in scale.global_index(df, ["o"]).collect()} == {"a": 0, "c": 1, "b": 2}
