"""Projections, filters, unions and membership."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.functions.arrays import literal_map, widen
from corvane.scale import lookup_join

# Colour of a single line, and of a place on several lines.
LINE_COLOURS = {"azul": "darkblue", "verde": "green", "vermelha": "red",
                "amarela": "beige", "lilas": "purple", "prata": "lightgray"}
SHARED_COLOUR = "black"


def flatten_struct(df: DataFrame, name: str) -> DataFrame:
    """Struct fields as columns, the struct itself dropped."""
    return df.select("*", f"{name}.*").drop(name)


def xy(df: DataFrame, targets: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Feature table and target table."""
    return df.drop(*targets), df.select(*targets)


def widen_array(df: DataFrame, name: str, n: int, prefix: str = "") -> DataFrame:
    return df.select("*", *widen(name, n, prefix)).drop(name)


def narrow_array(df: DataFrame, names: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, F.array(*names)).drop(*names)


def filter_any_contains(df: DataFrame, name: str, terms: Sequence[str]) -> DataFrame:
    return df.filter(reduce(Column.__or__, [F.contains(F.col(name), F.lit(t)) for t in terms]))


def for_actor(df: DataFrame, actor: str, name: str = "role") -> DataFrame:
    return df.filter(F.col(name) == actor)


def missing(df: DataFrame, name: str = "lat") -> DataFrame:
    """Rows whose coordinate holds the sentinel 0."""
    return df.filter(F.col(name) == 0)


def empty_sources(sources: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """Sources that produced no chunk."""
    return sources.join(chunks.select(key).distinct(), key, "left_anti")


def require_rows(df: DataFrame, message: str = "No text chunks were generated from the input files!") -> DataFrame:
    """The frame itself, or an error when it holds no row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def colour(lines: Column, table: dict[str, str] = LINE_COLOURS, shared: str = SHARED_COLOUR) -> Column:
    return F.when(F.size(lines) == 1, F.try_element_at(literal_map(table), F.array_min(lines))).otherwise(shared)


def resolve_side(df: DataFrame, alias: str | Column, white: str = "white", black: str = "black") -> DataFrame:
    """Add ``side`` and the opponent key; ``side`` is null where the alias plays neither side."""
    name = F.lit(alias) if isinstance(alias, str) else alias
    plays = [F.contains(F.lower(white), F.lower(name)), F.contains(F.lower(black), F.lower(name))]
    side = F.when(plays[0], "W").when(plays[1], "B")
    return df.withColumn("side", side).withColumn(
        "opponent", F.when(F.col("side") == "W", tx.actor_key(F.col(black)))
        .when(F.col("side") == "B", tx.actor_key(F.col(white))))


def split_inconsistent(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a resolved side, and the inconsistent rest."""
    return df.filter("side is not null"), df.filter("side is null")


def append(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_arrays(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def minus(df: DataFrame, seen: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key was not seen."""
    return lookup_join(df, seen.select(*on).distinct(), on, "left_anti")


def within(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    return lookup_join(df, members.select(*on).distinct(), on, "left_semi")


def with_fn(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Row function given as a column expression."""
    return df.withColumn(name, expr)


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Batched function over Arrow batches; the input columns are replaced by its output."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)
    return df.mapInPandas(run, schema)


def apply_map(df: DataFrame, name: str, table: dict, out: str | None = None) -> DataFrame:
    """Map a column through a table; unmapped values become null."""
    return df.withColumn(out or name, F.try_element_at(literal_map(table), F.col(name)))


def explode_records(df: DataFrame, records: Column, keep: Sequence[str]) -> DataFrame:
    """One row per record of an array-of-struct expression, its fields as columns."""
    return df.select(*keep, F.explode(records).alias("__r")).select(*keep, "__r.*")


def with_features(df: DataFrame, extractor: Callable[[Column, Column], Column],
                  state: str = "s", action: str = "a") -> DataFrame:
    """Feature rows from a caller's extractor, which returns an array of (name, value) structs."""
    return df.select("*", F.explode(extractor(F.col(state), F.col(action))).alias("__f")) \
        .select("*", F.col("__f.name").alias("feature"), F.col("__f.value").alias("value")).drop("__f")


def identity_features(state: Column, action: Column) -> Column:
    """One indicator feature per (state, action)."""
    return F.array(F.struct(F.concat_ws("|", state, action).alias("name"), F.lit(1.0).alias("value")))


def register_tools(spark: SparkSession) -> None:
    """Expose the token counter to SQL by name."""
    space = tx.SPACE.replace("\\", "\\\\")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION tokens_from_string(s STRING) RETURNS STRING
        RETURN concat('This string has ', size(array_remove(split(s, '{space}+'), '')), ' tokens.')""")
