"""Helpers of the operators for Spark rows: fresh names, Arrow kernels, bounded tables in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.kernels import blocks
from corvane.scale import materialize
from corvane.ship import ship

#: Entries of a table that every task may hold; at most 24 bytes each.
TABLE_ENTRIES = 2 ** 20


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads, as ``doc_id`` and ``text``."""
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def map_blocks(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
               text: str = "text", max_bytes: int | None = None) -> DataFrame:
    """Apply ``kernel`` to bounded blocks of Arrow rows inside each partition; no shuffle."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, max_bytes):
            yield kernel(block)
    return df.mapInArrow(run, schema)


def batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def histogram(counts: DataFrame, count: str = "n") -> dict[int, int]:
    """Rows by count: exact below 4,096, by lower bounds of eighths of powers of two above; at most 4,512 entries."""
    steps = F.when(F.col(count) < 4096, F.col(count)) \
        .otherwise(F.ceil(F.pow(F.lit(2.0), F.floor(F.log2(F.col(count).cast("double")) * 8) / 8))).cast("bigint")
    return {r["step"]: r["count"] for r in counts.select(steps.alias("step")).groupBy("step").count().collect()}


def least_count(rows: dict[int, int], entries: int = TABLE_ENTRIES) -> int:
    """The least step of a histogram that at most ``entries`` rows reach."""
    cut, total = 2 ** 62, 0
    for step in sorted(rows, reverse=True):
        total += rows[step]
        if total > entries:
            return cut
        cut = step
    return 1


def frequent(counts: DataFrame, count: str = "n", entries: int = TABLE_ENTRIES) -> int:
    """The least count that at most ``entries`` rows reach.

    Rows below it are not lost: the caller handles them without a table in memory.
    """
    return least_count(histogram(counts, count), entries)


def table(df: DataFrame, entries: int = TABLE_ENTRIES) -> dict[str, np.ndarray]:
    """Columns of a frame of at most ``entries`` rows, ordered by the first."""
    arrow = df.limit(entries + 1).toArrow()
    if arrow.num_rows > entries:
        raise ValueError(f"more than {entries} rows")
    columns = {name: arrow.column(name).to_numpy() for name in arrow.column_names}
    order = np.argsort(columns[arrow.column_names[0]], kind="stable")
    return {name: values[order] for name, values in columns.items()}


def shared(spark: SparkSession, value):
    """A read-only value for the tasks, sent once per executor."""
    return spark.sparkContext.broadcast(value)


__all__ = ["TABLE_ENTRIES", "batch", "frequent", "fresh", "histogram", "least_count", "map_blocks", "materialize", "shared", "table", "texts"]
