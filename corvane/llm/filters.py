"""A bit table over 64-bit keys that tasks use to pass over keys that cannot matter."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the largest table, 16 MB; more keys only make it let more through.
MOST_BITS = 2 ** 27
_BITS_PER_KEY = 16


class KeyFilter:
    """Every key it was made from passes; few others do while there are up to ``MOST_BITS / 16`` keys."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(64 * len(words) - 1)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in (keys & self.mask, keys >> np.uint64(32) & self.mask):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def key_filter(keys: DataFrame, column: str, most_bits: int = MOST_BITS) -> KeyFilter:
    """Filter over a column of well-mixed 64-bit hashes; the bits are set by a Spark aggregate, never key by key here."""
    n = keys.count()
    bits = min(1 << max(10, (_BITS_PER_KEY * n - 1).bit_length()), most_bits)
    key, mask = F.col(column), F.lit(bits - 1).cast("bigint")
    both = F.array(key.bitwiseAND(mask), F.shiftrightunsigned(key, 32).bitwiseAND(mask))
    at = keys.select(F.explode(both).alias("at"))
    bit = F.expr("shiftleft(1L, cast(at & 63 AS int))")
    found = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("set")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    return KeyFilter(words)
