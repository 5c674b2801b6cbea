"""Edges, reachability and least-cost paths as rounds of joins over stored edges."""

from __future__ import annotations

import math
import uuid
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.operators.lookup import edge_costs
from corvane.scale import ROWS_PER_TASK, fits_broadcast, limit, lookup_join, materialize, scratch_path


def edges(nodes: DataFrame) -> DataFrame:
    """(src, dst, cost) from nodes (id, x, y, neigh)."""
    links = nodes.select(F.col("id").alias("src"), F.explode("neigh").alias("dst"))
    return edge_costs(nodes.select("id", "x", "y"), links)


class Links:
    """An edge table written once for many rounds of joins on ``src``.

    Edges lie in files by hash of ``src``, so a round moves its frontier to them and never
    shuffles them. The edges of a node with more than ``rows_per_task`` of them lie apart, over
    many files, and meet a broadcast of the frontier's few such nodes.
    """

    def __init__(self, edge: DataFrame, rows_per_task: int | None = None):
        self.spark = edge.sparkSession
        most = limit(self.spark, "rowsPerTask", ROWS_PER_TASK, rows_per_task)
        self.edge = edge = materialize(edge, "links")
        # A bucket per quarter of a task's rows, so that small graphs do not pay for empty files each round.
        self.buckets = max(1, min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 4 * edge.count() // most))
        hot = edge.groupBy("src").agg(F.count("*").alias("__n")).filter(F.col("__n") > most).select("src")
        self.hot_ids = materialize(hot, "hot")     # at most one per ``most`` edges
        self.any_hot = not self.hot_ids.isEmpty()
        if self.any_hot:
            self.hot = materialize(edge.join(F.broadcast(self.hot_ids), "src", "left_semi"), "hot-links")
            edge = edge.join(F.broadcast(self.hot_ids), "src", "left_anti")
        self.cold = by_hash(edge, "src", self.buckets)

    def meet(self, frontier: DataFrame, fits: bool) -> DataFrame:
        """Edges that leave the frontier's nodes (unique ``src`` and any other columns)."""
        cold = self.cold.join(F.broadcast(frontier) if fits else frontier.hint("shuffle_hash"), "src")
        if not self.any_hot:
            return cold
        few = F.broadcast(frontier.join(F.broadcast(self.hot_ids), "src", "left_semi"))
        return cold.unionByName(self.hot.join(few, "src"))


def by_hash(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` written to the shared folder in ``buckets`` files by hash of ``key``; joins on ``key`` read it in place.

    The session's catalog knows the files as a table of a name of its own.
    """
    name = f"corvane_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", scratch_path(df.sparkSession, "by-hash"))
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


#: Tables of seen nodes or costs that a round reads; more are written together.
_SEEN_TABLES = 8


def reachable(edge: DataFrame, start: DataFrame, rows_per_task: int | None = None, max_rounds: int | None = None) -> DataFrame:
    """(id, hops) of every node reached from the ids in ``start``.

    Each round moves the new frontier to the stored edges, which are never shuffled again,
    reduces what it offers to distinct nodes inside the tasks, drops nodes seen before in one
    join and writes the rest. Rounds go on until one finds nothing, or fail after
    ``max_rounds`` if given.
    """
    links = Links(edge.select("src", "dst").filter("src is not null and dst is not null"), rows_per_task)
    frontier = materialize(start.select("id").filter("id is not null").distinct().withColumn("hops", F.lit(0)), "frontier")
    seen = [frontier]
    for hops in count(1):
        n, fits = fits_broadcast(frontier)
        if n == 0:
            return reduce(DataFrame.unionByName, seen)
        if max_rounds is not None and hops > max_rounds:
            raise RuntimeError(f"not finished after {max_rounds} rounds")
        frontier = materialize(next_level(links, frontier, seen, hops, fits), "frontier")
        seen.append(frontier)
        if len(seen) > _SEEN_TABLES:
            seen = [materialize(reduce(DataFrame.unionByName, seen), "seen")]


def next_level(links: Links, frontier: DataFrame, seen: list[DataFrame], hops: int, fits: bool) -> DataFrame:
    """(id, hops) of the nodes one edge beyond the frontier that no table of ``seen`` holds."""
    step = links.meet(frontier.select(F.col("id").alias("src")), fits).select(F.col("dst").alias("id")).distinct()
    return step.join(reduce(DataFrame.unionByName, seen).select("id"), "id", "left_anti").withColumn("hops", F.lit(hops))


def cost_tree(edge: DataFrame, start: str | int, goal: str | int | None = None, width: float | None = None,
              rows_per_task: int | None = None, max_rounds: int | None = None) -> DataFrame:
    """(id, cost, hops, pred): the least cost from ``start`` to every node it reaches, and the node before it.

    Costs are settled in buckets of ``width`` (unless given, four times the mean cost of an edge,
    as a round costs more than some offers made in vain): edges shorter than that are relaxed
    while nodes of the bucket still improve, longer ones once when it is done. A round moves its
    frontier to the stored edges, which are never shuffled again, reduces its offers to one per
    node inside the tasks, and drops those that a known cost beats in one sorted join, so no task
    holds more than a share of the frontier in memory. No path travels. Equal costs
    keep the fewer edges, then the lower predecessor, so predecessors form a tree even where
    edges cost nothing. With a ``goal``, offers above its best cost so far are dropped and
    nodes beyond it are left out.

    Edges without an end, or whose cost is null, NaN or infinite, do not exist; a negative cost
    is an error. Fails after ``max_rounds`` rounds if given.
    """
    spark, kind = edge.sparkSession, edge.schema["src"].dataType
    usable = edge.filter("src is not null and dst is not null and src <> dst and cost < double('infinity')")
    links = Links(usable.groupBy("src", "dst").agg(F.min(F.col("cost").cast("double")).alias("__w")), rows_per_task)
    least, mean, most = links.edge.agg(F.min("__w"), F.avg("__w"), F.max("__w")).first()
    if least is not None and least < 0:
        raise ValueError("costs must not be negative")
    width = width or 4 * (mean or 0.25)
    first = spark.range(1).select(F.lit(start).cast(kind).alias("id"), F.lit(0.0).alias("cost"),
                                  F.lit(0).alias("hops"), F.lit(None).cast(kind).alias("pred"))
    active = materialize(first, "costs")
    known, bucket, pending = [active], [active], []
    bound, end, rounds = math.inf, width, 0

    def together(tables: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, tables)

    def relax(nodes: DataFrame, fits: bool, which: Column) -> DataFrame:
        nonlocal known, bound, rounds
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"not finished after {max_rounds} rounds")
        better = materialize(offers(links, nodes, known, fits, which, bound), "costs")
        known.append(better)
        if len(known) > _SEEN_TABLES:
            known = [materialize(_cheapest(together(known)), "costs")]
        if goal is not None:
            reached = better.filter(F.col("id") == F.lit(goal)).agg(F.min("cost")).first()[0]
            bound = bound if reached is None else min(bound, reached)
        return better

    while True:
        n, fits = fits_broadcast(active)
        while n:
            better = relax(active, fits, F.col("__w") < width)
            active = better.filter(F.col("cost") < end)
            bucket.append(active)
            pending.append(better.filter(F.col("cost") >= end))
            n, fits = fits_broadcast(active)
        if most is not None and most >= width:
            done = _cheapest(together(bucket))
            pending.append(relax(done, fits_broadcast(done)[1], F.col("__w") >= width))
        waiting = materialize(_without(together(pending), known, "k.pred < o.pred"), "waiting")
        low = waiting.agg(F.min("cost")).first()[0]
        if low is None or low > bound:
            return _cheapest(together(known)).filter(F.col("cost") <= bound)
        end = max((math.floor(low / width) + 1) * width, math.nextafter(low, math.inf))
        active = waiting.filter(F.col("cost") < end)
        bucket, pending = [active], [waiting.filter(F.col("cost") >= end)]


def offers(links: Links, nodes: DataFrame, known: list[DataFrame], fits: bool, which: Column, bound: float) -> DataFrame:
    """(id, cost, hops, pred) one edge beyond ``nodes`` that beat every row of every table of ``known``."""
    step = links.meet(nodes.select(F.col("id").alias("src"), "cost", "hops"), fits).filter(which)
    step = step.select(F.col("dst").alias("id"), (F.col("cost") + F.col("__w")).alias("cost"),
                       (F.col("hops") + 1).alias("hops"), F.col("src").alias("pred"))
    return _without(_cheapest(step.filter(F.col("cost") <= F.lit(bound))), known, "k.pred <= o.pred")


def _without(rows: DataFrame, known: list[DataFrame], tie: str) -> DataFrame:
    """``rows`` that no row of a table of ``known`` with their id beats; ``tie`` decides between equal costs and hops."""
    beats = f"k.id = o.id and (k.cost < o.cost or k.cost = o.cost and (k.hops < o.hops or k.hops = o.hops and {tie}))"
    return rows.alias("o").join(reduce(DataFrame.unionByName, known).alias("k"), F.expr(beats), "left_anti")


def _cheapest(rows: DataFrame) -> DataFrame:
    best = F.min(F.struct("cost", "hops", "pred")).alias("o")
    return rows.groupBy("id").agg(best).select("id", "o.*")


def path_rows(tree: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """(id, depth, node): the path of every node, or of the ids in ``ends``, from itself (depth 0) back to the start.

    Predecessors are doubled: each round joins the rows so far to the node 1, 2, 4, ... edges
    before, so a path of n edges takes log2(n) rounds and no path is held in one value.
    """
    jump = tree.filter("pred is not null").select("id", F.col("pred").alias("up"))
    parts = [tree.select("id", F.lit(0).alias("depth"), F.col("id").alias("node"))]
    if ends is not None:
        parts = [materialize(parts[0].join(ends.select("id").distinct(), "id", "left_semi"), "path")]
    longest, step = tree.agg(F.max("hops")).first()[0] or 0, 1
    while step <= longest:
        rows = reduce(DataFrame.unionByName, parts)
        far = lookup_join(rows, jump.select(F.col("id").alias("node"), "up"), ["node"], "inner")
        parts.append(materialize(far.select("id", (F.col("depth") + step).alias("depth"), F.col("up").alias("node")), "path"))
        step *= 2
        if step <= longest:
            twice = lookup_join(jump.select("id", F.col("up").alias("mid")), jump.select(F.col("id").alias("mid"), "up"), ["mid"], "inner")
            jump = materialize(twice.select("id", "up"), "jump")
    return reduce(DataFrame.unionByName, parts)


def with_paths(tree: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """(id, cost, path) from start to node; rows of a path meet in one task only to be put in order."""
    rows = path_rows(tree, ends).repartition("id")
    listed = F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("at"), "node")))
    paths = rows.groupBy("id").agg(F.transform(listed, lambda e: e["node"]).alias("path"))
    return tree.select("id", "cost").join(paths, "id")


def least_costs(edge: DataFrame, start: str | int, max_rounds: int | None = None) -> DataFrame:
    """(id, cost, path) of the cheapest path from ``start`` to every node it reaches."""
    return with_paths(materialize(cost_tree(edge, start, max_rounds=max_rounds), "tree"))


def least_cost_path(edge: DataFrame, start: str | int, goal: str | int) -> DataFrame:
    """(id, cost, path) from ``start`` to ``goal``; no row when it is not reached."""
    tree = materialize(cost_tree(edge, start, goal), "tree")
    return with_paths(tree, tree.filter(F.col("id") == F.lit(goal)))


def unroll(paths: DataFrame, path: str = "path") -> DataFrame:
    """One row per node of a path, from the goal back to the start."""
    keep = [c for c in paths.columns if c != path]
    return paths.select(*keep, F.posexplode(F.reverse(path)).alias("depth", "node"))
