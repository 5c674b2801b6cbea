"""Ordered sequences: positions, states before actions, neighbours, repeats.

All of them go through ``Ordered``, so a key with a third of all rows is spread over
many tasks. ``order`` names ascending columns that are unique inside a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.arrays import euclid
from corvane.scale import Ordered, lookup_join


def turn_index(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "turn_count",
               rows_per_task: int | None = None) -> DataFrame:
    """0-based turn, full-move number (two turns each) and the colour to move."""
    out = Ordered(df, key, order, rows_per_task).index(name).result()
    return out.withColumns({
        "full_move_count": F.expr(f"{name} div 2 + 1"),
        "turn_color": F.when(F.col(name) % 2 == 0, "W").otherwise("B")})


def trajectory(df: DataFrame, key: Sequence[str], order: Sequence[str], action: str,
               symbols: Sequence[str], terminal: bool = False, keep: Sequence[str] = (),
               rows_per_task: int | None = None) -> DataFrame:
    """One row per step: the state before it (count of each symbol so far) and the action.

    With ``terminal`` each sequence also ends in one row with its final state and a
    null action.
    """
    ordered = Ordered(df.select(*key, *order, action, *[c for c in keep if c not in order]), key, order, rows_per_task)
    flags = {f"n_{s}": (F.col(action) == s).cast("bigint") for s in symbols}
    steps = ordered.index("step").running(inclusive=False, **flags).result()
    state = F.array(*[F.col(n) for n in flags]).alias("state")
    steps = steps.select(*key, "step", state, F.col(action).alias("action"), *keep)
    if not terminal:
        return steps
    final = df.groupBy(*key).agg(F.count("*").alias("step"), *[F.sum(e).alias(n) for n, e in flags.items()])
    null = [F.lit(None).cast(steps.schema[c].dataType).alias(c) for c in ("action", *keep)]
    return steps.unionByName(final.select(*key, "step", state, *null))


def recent(df: DataFrame, key: Sequence[str], order: Sequence[str], last: int, cols: Sequence[str],
           include_self: bool = False, out: str = "history", rows_per_task: int | None = None) -> DataFrame:
    """Add the ``last`` rows before each row (or up to it), oldest first, as an array of structs."""
    return Ordered(df, key, order, rows_per_task).history(out, cols, last, include_self).result()


def running_state(df: DataFrame, key: Sequence[str], order: Sequence[str], role: str, text: str,
                  roles: Sequence[str] = ("system", "user", "assistant"),
                  rows_per_task: int | None = None) -> DataFrame:
    """Thread state after each step: messages per role, characters so far, last message."""
    sums = {f"n_{r}": (F.col(role) == r).cast("bigint") for r in roles}
    ordered = Ordered(df.select(*key, *order, role, text), key, order, rows_per_task)
    out = ordered.running(**sums, n_chars=F.length(text).cast("bigint")).result()
    return out.withColumn("n_messages", sum((F.col(n) for n in sums), F.lit(0))) \
        .withColumnsRenamed({role: "last_role", text: "last_text"})


def dedup_adjacent(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
                   rows_per_task: int | None = None) -> DataFrame:
    """Drop a row whose value equals that of the row before it."""
    seen = Ordered(df, key, order, rows_per_task).index("__ix").lag(__prev=value).result()
    same = (F.col("__ix") > 0) & F.col("__prev").eqNullSafe(F.col(value))
    return seen.filter(~same).drop("__ix", "__prev")


def take_until_repeat(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str,
                      rows_per_task: int | None = None) -> DataFrame:
    """Rows of each source before its first adjacent repeat."""
    first = Ordered(df, key, order, rows_per_task)
    seen = first.index("__ix").lag(__prev=value).result()
    repeat = ((F.col("__ix") > 0) & F.col("__prev").eqNullSafe(F.col(value))).cast("bigint")
    second = Ordered(seen.withColumn("__rep", repeat), key, order, rows_per_task, first.sizes)
    return second.running(__n=F.col("__rep")).result().filter("__n = 0").drop("__ix", "__prev", "__rep", "__n")


def transitions(df: DataFrame, key: Sequence[str], order: Sequence[str], state: str,
                action: Column, reward: str, rows_per_task: int | None = None) -> DataFrame:
    """(s, a, r, s_next) per step; the last step of a sequence has a null ``s_next``."""
    base = df.select(*key, *order, F.col(state).alias("s"), action.alias("a"), F.col(reward).alias("r"))
    return Ordered(base, key, order, rows_per_task).lead(s_next="s").result()


def prefix(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` steps per sequence; each task drops later rows before the shuffle."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__r")


def first_seen(df: DataFrame, key: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Columns of the first row per key, combined before the shuffle."""
    first = F.min_by(F.struct(*cols), F.struct(*order)).alias("__first")
    return df.groupBy(*key).agg(first).select(*key, "__first.*")


def every_n(df: DataFrame, step: str, n: int) -> DataFrame:
    return df.filter(F.col(step) % n == 0)


def line_neighbours(points: DataFrame, line: str = "line", id_: str = "id", x: str = "x", y: str = "y",
                    rows_per_task: int | None = None) -> DataFrame:
    """Previous and next member of each line, ordered by distance from the line's end point.

    The end point is the member with the lowest id.
    """
    ends = points.groupBy(line).agg(F.min_by(F.struct(F.col(x).alias("__x"), F.col(y).alias("__y")), id_).alias("__end")) \
        .select(line, "__end.*")
    placed = lookup_join(points, ends, [line]).withColumn(
        "dist", euclid(F.col("__x"), F.col("__y"), F.col(x), F.col(y))).drop("__x", "__y")
    return Ordered(placed, [line], ["dist", id_], rows_per_task).lag(prev=id_).lead(next=id_).result()


def neighbour_lists(neighbours: DataFrame, id_: str = "id") -> DataFrame:
    """Sorted distinct neighbours of each member over all its lines."""
    both = neighbours.select(id_, F.explode(F.array("prev", "next")).alias("n")).filter("n is not null")
    return both.groupBy(id_).agg(F.array_sort(F.collect_set("n")).alias("neigh"))
