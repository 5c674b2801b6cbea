"""Lookups: symbol tables, edge costs, distances, fills and pairings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.arrays import euclid, literal_map
from corvane.scale import fits_broadcast, lookup_join


def encode_column(df: DataFrame, name: str, table: dict) -> DataFrame:
    """Replace mapped values; unmapped ones pass through as text."""
    found = F.try_element_at(literal_map({k: str(v) for k, v in table.items()}), F.col(name))
    return df.withColumn(name, F.coalesce(found, F.col(name).cast("string")))


def encode_from(df: DataFrame, name: str, table: DataFrame, out: str) -> DataFrame:
    """Lookup in a table of (``name``, ``out``) of any size, unmapped values passing through."""
    joined = lookup_join(df, table.select(name, out), [name])
    return joined.withColumn(out, F.coalesce(F.col(out), F.col(name).cast("string")))


def last_wins(table: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """One row per key: the value listed last."""
    return table.groupBy(key).agg(F.max_by(value, position).alias(value))


def edge_costs(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Euclidean cost of edges (src, dst) from nodes (id, x, y)."""
    a = nodes.select(F.col("id").alias("src"), F.col("x").alias("__ax"), F.col("y").alias("__ay"))
    b = nodes.select(F.col("id").alias("dst"), F.col("x").alias("__bx"), F.col("y").alias("__by"))
    _, fits = fits_broadcast(a)
    both = lookup_join(lookup_join(edges, a, ["src"], "inner", fits=fits), b, ["dst"], "inner", fits=fits)
    cost = euclid(F.col("__ax"), F.col("__ay"), F.col("__bx"), F.col("__by"))
    return both.withColumn("cost", cost).drop("__ax", "__ay", "__bx", "__by")


def distances(points: DataFrame, probe: DataFrame) -> DataFrame:
    """Distance of every point (id, x, y) from the single probe row, read as scalar subqueries."""
    px, py = probe.select("x").scalar(), probe.select("y").scalar()
    return points.withColumn("dist", euclid(px, py, F.col("x"), F.col("y")))


def fill_from(df: DataFrame, override: DataFrame, on: Sequence[str], cols: Sequence[str],
              sentinel: float = 0) -> DataFrame:
    """Override by key; a sentinel without an override becomes null, so fills can be chained."""
    side = override.select(*on, *[F.col(c).alias(f"__o_{c}") for c in cols])
    joined = lookup_join(df, side, on)
    fixed = {c: F.coalesce(F.col(f"__o_{c}"), F.nullif(F.col(c), F.lit(sentinel))) for c in cols}
    return joined.withColumns(fixed).drop(*[f"__o_{c}" for c in cols])


def fill_missing(df: DataFrame, second: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Second source for values that are still null."""
    side = second.select(*on, *[F.col(c).alias(f"__o_{c}") for c in cols])
    fixed = {c: F.coalesce(F.col(c), F.col(f"__o_{c}")) for c in cols}
    return lookup_join(df, side, on).withColumns(fixed).drop(*[f"__o_{c}" for c in cols])


def pair(pred: DataFrame, ref: DataFrame, on: Sequence[str]) -> DataFrame:
    """Prediction and reference rows with the same unique row key."""
    return pred.join(ref, list(on))


def parse_reigns(df: DataFrame, line: str) -> DataFrame:
    """(alias, year) rows from lines such as ``1993, 1995 (Name)``; lines without a name yield none."""
    alias = F.regexp_extract(line, r"\((.+?)\)", 1)
    years = F.split(F.replace(F.regexp_extract(line, r"(.+)\(", 1), F.lit(" "), F.lit("")), ",")
    return df.select(alias.alias("alias"), F.explode(years).alias("year")).filter("alias <> ''")


