"""Reachability and least costs over stored edges: hot nodes, long chains, ties, and plans that leave the edges in place."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from corvane.operators import graph as gr


def levels(edges, start):
    out, todo = {s: 0 for s in start}, deque(start)
    while todo:
        a = todo.popleft()
        for x, y in edges:
            if x == a and y not in out:
                out[y] = out[a] + 1
                todo.append(y)
    return out


@pytest.mark.parametrize("rows_per_task", [None, 10])
def test_hot_node_chain_and_cycle(spark, rows_per_task):
    edges = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 111)] + [(111, 100), (59, 100), (59, 100), (7, 7), (300, 301)]
    table = spark.createDataFrame(edges + [(None, 5), (3, None)], "src long, dst long").repartition(4)
    start = spark.createDataFrame([(0,), (0,), (None,)], "id long")
    got = {r["id"]: r["hops"] for r in gr.reachable(table, start, rows_per_task).collect()}
    assert got == levels(edges, [0]) and max(got.values()) == 13
    assert gr.reachable(table.limit(0), start).count() == 1
    assert gr.reachable(table, start.limit(0)).count() == 0


def test_a_round_shuffles_neither_edges_nor_seen_nodes(spark):
    table = spark.range(400).selectExpr("id as src", "id * 7 % 400 as dst")
    links = gr.Links(table)
    frontier = gr.by_hash(spark.range(50).selectExpr("id", "0 as hops"), "id", links.buckets)
    old = gr.by_hash(spark.range(60, 90).selectExpr("id", "0 as hops"), "id", links.buckets)
    for fits in (True, False):
        step = gr.next_level(links, frontier, [old, frontier], 1, fits)
        plan = step._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        # The step itself, and the frontier's way to the edges where it is not broadcast.
        assert len(shuffles) <= (1 if fits else 2), plan
        assert {r["id"] for r in step.collect()} == {i * 7 % 400 for i in range(50)} - set(range(50)) - set(range(60, 90))


def costs_model(links, start):
    """Bellman-Ford on (cost, edges)."""
    best = {start: (0.0, 0)}
    changed = True
    while changed:
        changed = False
        for a, b, c in links:
            if a in best and a != b:
                offer = (best[a][0] + c, best[a][1] + 1)
                if b not in best or offer < best[b]:
                    best[b], changed = offer, True
    return best


@pytest.fixture
def split_scans(spark):
    """Every file is a partition of its own, as large tables have it."""
    with_values = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "2000"}
    before = {k: spark.conf.get(k) for k in with_values}
    for k, v in with_values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("width", "rows_per_task"), [(None, 10), (4.0, None)])
def test_least_costs_with_ties_and_free_edges(spark, width, rows_per_task, split_scans):
    rng = random.Random(3)
    links = [(0, i, float(rng.randrange(0, 9))) for i in range(1, 25)]
    links += [(rng.randrange(40), rng.randrange(40), float(rng.choice([0, 0, 1, 2, 7]))) for _ in range(120)]
    links += [(40 + i, 41 + i, 1.0) for i in range(8)] + [(39, 40, 0.0), (24, 40, 0.0)]
    odd = [(None, 1, 1.0), (0, None, 1.0), (0, 77, None), (0, 78, float("nan")), (0, 79, float("inf")), (5, 5, 0.0)]
    table = spark.createDataFrame(links + links[:9] + odd, "src long, dst long, cost double").repartition(5)
    tree = gr.materialize(gr.cost_tree(table, 0, width=width, rows_per_task=rows_per_task))
    got = {r["id"]: r for r in tree.collect()}
    assert len(got) == tree.count()
    want = costs_model(links, 0)
    assert {k: (r["cost"], r["hops"]) for k, r in got.items()} == want
    walked = {}
    for r in gr.path_rows(tree).collect():
        walked.setdefault(r["id"], {})[r["depth"]] = r["node"]
    for node, steps in walked.items():
        at = node
        for depth in range(got[node]["hops"] + 1):
            assert steps[depth] == at
            at = got[at]["pred"]
        assert at is None and len(steps) == got[node]["hops"] + 1
    assert set(walked) == set(want) and max(r["hops"] for r in got.values()) >= 8


def test_goal_start_alone_and_bad_costs(spark):
    chain = [(i, i + 1, 1.0) for i in range(4)] + [(0, 4, 100.0), (0, 50, 4.0), (50, 51, 90.0)]
    table = spark.createDataFrame(chain, "src long, dst long, cost double")
    near = {r["id"]: r["cost"] for r in gr.cost_tree(table, 0, goal=3).collect()}
    assert near == {0: 0.0, 1: 1.0, 2: 2.0, 3: 3.0}
    assert gr.least_cost_path(table, 0, 4).first()["path"] == [0, 1, 2, 3, 4]
    assert gr.least_cost_path(table, 4, 0).isEmpty()
    assert [tuple(r) for r in gr.least_costs(table.limit(0), 9).collect()] == [(9, 0.0, [9])]
    with pytest.raises(ValueError):
        gr.cost_tree(table.selectExpr("src", "dst", "-cost as cost"), 0)
    with pytest.raises(RuntimeError):
        gr.cost_tree(table, 0, max_rounds=1)


def test_offers_shuffle_no_edges_costs_or_paths(spark):
    links = gr.Links(spark.range(400).selectExpr("id as src", "id * 7 % 400 as dst", "1.0d as __w"))
    row = ("id", "double(id) as cost", "1 as hops", "id as pred")
    nodes = gr.by_hash(spark.range(50).selectExpr(*row), "id", links.buckets)
    known = gr.by_hash(spark.range(60, 90).selectExpr(*row), "id", links.buckets)
    for fits in (True, False):
        step = gr.offers(links, nodes, [known, nodes], fits, F.col("__w") < 2, 1e9)
        plan = step._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert len(shuffles) <= (1 if fits else 2) and "array" not in plan, plan


def test_a_round_meets_all_known_costs_in_one_join(spark):
    """One hash table a known table and task cannot be spilled; their number grew with the rounds."""
    links = gr.Links(spark.range(400).selectExpr("id as src", "id * 7 % 400 as dst", "1.0d as __w"))
    known = [spark.range(i, i + 40).selectExpr("id", "0.0d as cost", "0 as hops", "id as pred") for i in range(0, 160, 20)]
    step = gr.offers(links, known[0], known, False, F.lit(True), 1e9)
    plan = step._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1, plan
    seen = gr.next_level(links, known[0], known, 1, False)
    assert seen._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 1
    assert {r["id"] for r in step.collect()} == {i * 7 % 400 for i in range(40)} - set(range(180))
