"""Sorts, heads, samples and exact splits.

Samples and splits order rows by a hash of the key, find the boundary by counting
buckets, and are then a plain filter: no global sort, and any engine or partitioning
picks the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.scale import hash_key, limit, nth_smallest

# A sample up to this size is a top-n; every task hands on that many rows.
SAMPLE_ROWS = 1_000


def sort_by_latest(df: DataFrame, years: str, name: str) -> DataFrame:
    """Latest year first, then name."""
    return df.orderBy(F.array_max(years).desc(), F.col(name))


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _first_by_hash(df: DataFrame, keys: DataFrame, key: Sequence[str], n: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is among the first ``n`` of the unique ``keys`` by hash, and the rest."""
    hashed = hash_key(*key, seed=seed)
    if n <= 0:
        return df.limit(0), df
    edge, below = nth_smallest(keys.select(hashed.alias("h")), "h", n)
    tied = keys.filter(hashed == edge).orderBy(*key).limit(n - below + 1).select(*key).collect()
    if len(tied) <= n - below:
        taken = hashed <= edge
    else:  # equal hashes straddle the boundary: the lower keys go first
        chosen = F.lit(False)
        for row in tied[:n - below]:
            same = F.lit(True)
            for c in key:
                same = same & F.col(c).eqNullSafe(F.lit(row[c]))
            chosen = chosen | same
        taken = (hashed < edge) | ((hashed == edge) & chosen)
    return df.filter(taken), df.filter(~taken)


def sample_n(df: DataFrame, n: int, seed: int, key: Sequence[str]) -> DataFrame:
    """Exactly ``n`` rows (all when fewer); ``key`` is unique."""
    if n <= limit(df.sparkSession, "sampleRows", SAMPLE_ROWS):
        return df.orderBy(hash_key(*key, seed=seed), *key).limit(n)
    return _first_by_hash(df, df, key, min(n, df.count()), seed)[0]


def split(df: DataFrame, frac: float, seed: int, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ``ceil(frac * n)`` test rows; ``key`` is unique."""
    test, train = _first_by_hash(df, df, key, ceil(df.count() * frac), seed)
    return train, test


def group_split(df: DataFrame, frac: float, seed: int, group: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(train, test) where groups stay whole; the test side takes ``ceil(frac * groups)`` groups.

    Membership follows from the hash of the group key, so rows of a hot group never meet.
    """
    groups = df.select(*group).distinct()
    test, train = _first_by_hash(df, groups, group, ceil(groups.count() * frac), seed)
    return train, test


def tail_split(df: DataFrame, frac: float, order: str) -> tuple[DataFrame, DataFrame]:
    """(train, validation) by input order of the unique integer ``order``; the last part validates."""
    n = df.count()
    first = int(n * (1 - frac))
    if first == 0:
        return df.limit(0), df
    edge, _ = nth_smallest(df, order, first)
    return df.filter(F.col(order) <= edge), df.filter(F.col(order) > edge)
