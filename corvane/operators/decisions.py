"""Transition models, Q values and policies over logged transitions (s, a, r, s_next)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.scale import lookup_join, materialize, uniform


def transition_counts(tr: DataFrame) -> DataFrame:
    """Rows and reward sum per (s, a, s_next); the only pass over the log."""
    return tr.groupBy("s", "a", "s_next").agg(F.count("*").alias("n"), F.sum("r").alias("sum_r"))


def transition_model(tr: DataFrame) -> DataFrame:
    """P(s_next given s, a) and the mean reward; a null ``s_next`` is the terminal outcome."""
    counts = materialize(transition_counts(tr), "model")
    totals = counts.groupBy(F.col("s").alias("__s"), F.col("a").alias("__a")).agg(F.sum("n").alias("total"))
    same = F.col("s").eqNullSafe(F.col("__s")) & F.col("a").eqNullSafe(F.col("__a"))
    return counts.join(totals, same).select(
        "s", "a", "s_next", "n", (F.col("n") / F.col("total")).alias("p"), (F.col("sum_r") / F.col("n")).alias("mean_r"))


def q_score(features: DataFrame, weights: DataFrame, by: Sequence[str] = ("s", "a")) -> DataFrame:
    """Sum of weight times feature value; features without a weight count 0."""
    scored = lookup_join(features, weights.select("feature", "w"), ["feature"])
    return scored.groupBy(*by).agg(F.sum(F.coalesce("w", F.lit(0.0)) * F.col("value")).alias("q"))


def greedy(q: DataFrame) -> DataFrame:
    """Best action per state; equal values go to the larger action name."""
    return q.groupBy("s").agg(F.max_by("a", F.struct("q", "a")).alias("a"), F.max("q").alias("q"))


def td_error(tr: DataFrame, q: DataFrame, gamma: float) -> DataFrame:
    """r + gamma max Q(s_next, .) - Q(s, a) per transition; terminal and unseen values are 0."""
    best = q.groupBy(F.col("s").alias("s_next")).agg(F.max("q").alias("__best"))
    known = lookup_join(lookup_join(tr, q.select("s", "a", F.col("q").alias("__q")), ["s", "a"]), best, ["s_next"])
    zero = F.lit(0.0)
    td = F.col("r") + gamma * F.coalesce("__best", zero) - F.coalesce("__q", zero)
    return known.withColumn("td", td).drop("__q", "__best")


def td_mse(errors: DataFrame) -> DataFrame:
    return errors.agg(F.avg(F.col("td") * F.col("td")).alias("mse"))


def fitted_q(tr: DataFrame, gamma: float, rounds: int, backup: str = "max") -> DataFrame:
    """Q(s, a) after ``rounds`` backups from 0.

    The log is reduced once to (s, a, s_next) counts; every round reads that table and
    writes its Q table. ``max`` bootstraps with the best next action, ``same`` with the same action
    and leaves terminal rows out.
    """
    model = transition_counts(tr if backup == "max" else tr.filter("s_next is not null"))
    model = materialize(model, "model")
    q = model.groupBy("s", "a").agg(F.lit(0.0).alias("q"))
    for _ in range(rounds):
        if backup == "max":
            value = q.groupBy(F.col("s").alias("s_next")).agg(F.max("q").alias("v"))
            seen = lookup_join(model, value, ["s_next"])
        else:
            value = q.select(F.col("s").alias("s_next"), "a", F.col("q").alias("v"))
            seen = lookup_join(model, value, ["s_next", "a"])
        target = F.sum(F.col("sum_r") + gamma * F.col("n") * F.coalesce("v", F.lit(0.0)))
        q = materialize(seen.groupBy("s", "a").agg((target / F.sum("n")).alias("q")), "q")
    return q


def policy(df: DataFrame, q: DataFrame, eps: float, seed: int, key: Sequence[str], state: str = "s") -> DataFrame:
    """Action per row: with probability ``eps`` any action of the state, else the greedy one.

    Draws hash the row key, so a row keeps its action however often it is computed.
    """
    table = q.groupBy(F.col("s").alias(state)).agg(
        F.array_sort(F.collect_set("a")).alias("__actions"), F.max_by("a", F.struct("q", "a")).alias("__greedy"))
    known = lookup_join(df, table, [state])
    draw, pick = uniform(*key, seed=seed), uniform(*key, seed=seed + 1)
    any_action = F.get("__actions", F.floor(pick * F.size("__actions")).cast("int"))
    return known.withColumn("explore", draw < eps).withColumn(
        "a", F.when(F.col("explore"), any_action).otherwise(F.col("__greedy"))).drop("__actions", "__greedy")
