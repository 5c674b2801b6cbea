"""Queries over the given tables, each with its DuckDB equivalent where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from corvane.scale import spread
from corvane.ship import ship


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(t)``; ``t("orders")`` reads a table lazily."""
    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(ship(spark), sf_dir))
        REGISTRY[name] = Query(run, sql)
        return fn
    return register


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def spread(self, name: str, *key: str) -> DataFrame:
        """A table whose rows are heavy to process, over all cores."""
        return spread(self(name), *key)

    def path(self, name: str) -> str:
        return f"{self.sf_dir.rstrip('/')}/{name}.parquet"


def load_all() -> dict[str, Query]:
    from corvane.plans import (decisions, graphs, lookups, models, rows, sequences,  # noqa: F401
                               sources, splits, stats, streams, text)
    return REGISTRY
