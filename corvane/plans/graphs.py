"""Graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators import graph as gr
from corvane.operators import lookup as lk
from corvane.operators import sequences as sq
from corvane.plans import query
from corvane.plans.lookups import PLACES, places, trade_links
from corvane.plans.sequences import STATIONS, station_lines
from corvane.scale import lookup_join, materialize


@query("g1_edges", f"""WITH {STATIONS},
    links AS (SELECT DISTINCT id AS src, n AS dst FROM (SELECT id, unnest([prev, next]) AS n FROM linked) WHERE n IS NOT NULL),
    pos AS (SELECT DISTINCT id, x, y FROM stations)
    SELECT src, dst, round(sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y)), 6) AS cost
    FROM links JOIN pos a ON a.id = src JOIN pos b ON b.id = dst""")
def g1(t):
    lines = station_lines(t)
    near = sq.neighbour_lists(sq.line_neighbours(lines))
    nodes = lines.select("id", "x", "y").distinct().join(near, "id")
    return gr.edges(nodes).select("src", "dst", F.round("cost", 6).alias("cost"))


def _trade_graph(t):
    """Customers and suppliers, joined by an order line in both directions."""
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("c"))
    lines = t("lineitem").select("l_orderkey", F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("s"))
    pairs = materialize(lookup_join(lines, orders, ["l_orderkey"], "inner").select("c", "s").distinct(), "pairs")
    return pairs.select(F.col("c").alias("src"), F.col("s").alias("dst")).unionByName(
        pairs.select(F.col("s").alias("src"), F.col("c").alias("dst")))


def _levels(n: int) -> str:
    parts = ["""pairs AS (SELECT DISTINCT 'c' || o_custkey AS c, 's' || l_suppkey AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
             "e AS (SELECT c AS src, s AS dst FROM pairs UNION ALL SELECT s, c FROM pairs)",
             "h0 AS (SELECT min(c) AS id, 0 AS hops FROM pairs)"]
    for i in range(n):
        parts.append(f"h{i + 1} AS (SELECT id, min(hops) AS hops FROM (SELECT * FROM h{i} UNION ALL "
                     f"SELECT dst, {i + 1} FROM h{i} JOIN e ON src = id WHERE hops = {i}) GROUP BY id)")
    return ", ".join(parts)


@query("g2_reachable", f"WITH {_levels(8)} SELECT id, hops FROM h8")
def g2(t):
    edge = _trade_graph(t)
    start = edge.filter("src like 'c%'").agg(F.min("src").alias("id"))
    return gr.reachable(edge, start)


def _relaxed(rounds: int) -> str:
    parts = [PLACES, "d0 AS (SELECT 0 AS id, 0.0::DOUBLE AS cost, '0' AS path)"]
    for i in range(rounds):
        parts.append(f"d{i + 1} AS (SELECT id, min(cost) AS cost, arg_min(path, cost) AS path FROM (SELECT * FROM d{i} UNION ALL "
                     f"SELECT dst, d.cost + e.cost, path || ' ' || dst FROM d{i} d JOIN edge e ON src = d.id) GROUP BY id)")
    return ", ".join(parts)


def _costs(t):
    return gr.least_costs(lk.edge_costs(places(t), trade_links(t)), 0)


@query("g3_least_costs", f"WITH {_relaxed(6)} SELECT id, round(cost, 6) AS cost, path FROM d6")
def g3(t):
    return _costs(t).select("id", F.round("cost", 6).alias("cost"), F.array_join("path", " ").alias("path"))


@query("g3_least_cost_path", f"WITH {_relaxed(6)} SELECT id, round(cost, 6) AS cost, path FROM d6 WHERE id = 22")
def g3_goal(t):
    edge = lk.edge_costs(places(t), trade_links(t))
    path = gr.least_cost_path(edge, 0, 22)
    return path.select("id", F.round("cost", 6).alias("cost"), F.array_join("path", " ").alias("path"))


def _tolls(rounds: int) -> str:
    """Costs and edge counts together: every cost is a whole number, so one number holds both exactly."""
    parts = ["""toll AS MATERIALIZED (SELECT 'c' || o_custkey AS c, 's' || l_suppkey AS s, min(l_quantity)::BIGINT * 100000 + 1 AS w
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)""",
             "e AS MATERIALIZED (SELECT c AS src, s AS dst, w FROM toll UNION ALL SELECT s, c, w FROM toll)",
             "t0 AS MATERIALIZED (SELECT min(c) AS id, 0::BIGINT AS d FROM toll)"]
    for i in range(rounds):
        parts.append(f"t{i + 1} AS MATERIALIZED (SELECT id, min(d) AS d FROM (SELECT * FROM t{i} UNION ALL "
                     f"SELECT dst, d + w FROM t{i} JOIN e ON src = id) GROUP BY id)")
    return ", ".join(parts)


@query("g3_trade_costs", f"WITH {_tolls(24)} SELECT id, (d // 100000)::DOUBLE AS cost, (d % 100000)::INT AS hops FROM t24")
def g3_trade(t):
    """The customer-supplier graph; an edge costs the least quantity of its order lines."""
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("c"))
    lines = t("lineitem").select("l_orderkey", F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("s"), "l_quantity")
    toll = lookup_join(lines, orders, ["l_orderkey"], "inner").groupBy("c", "s").agg(F.min("l_quantity").alias("cost"))
    toll = materialize(toll, "toll")
    edge = toll.select(F.col("c").alias("src"), F.col("s").alias("dst"), "cost").unionByName(
        toll.select(F.col("s").alias("src"), F.col("c").alias("dst"), "cost"))
    return gr.cost_tree(edge, toll.agg(F.min("c")).first()[0]).select("id", "cost", "hops")


@query("g4_path_rows", f"""WITH {_relaxed(6)} SELECT id, (len(p) - i)::INT AS depth, p[i]::INT AS node FROM (
    SELECT id, string_split(path, ' ') AS p, unnest(generate_series(1, len(string_split(path, ' ')))) AS i FROM d6)""")
def g4_rows(t):
    tree = materialize(gr.cost_tree(lk.edge_costs(places(t), trade_links(t)), 0), "tree")
    return gr.path_rows(tree)


@query("g4_unroll_path", f"""WITH {_relaxed(6)} SELECT id, (len(p) - i)::INT AS depth, p[i]::INT AS node FROM (
    SELECT id, string_split(path, ' ') AS p, unnest(generate_series(1, len(string_split(path, ' ')))) AS i FROM d6)""")
def g4(t):
    return gr.unroll(_costs(t).select("id", "path"))
