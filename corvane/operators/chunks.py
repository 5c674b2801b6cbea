"""Cut long texts into overlapping pieces.

Each cutter walks a text once: it first takes equal blocks (one linear pass) and then
builds every piece from neighbouring blocks, so the cost stays linear in the text
length however long one document is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import text as tx

# Fixed values: (size, overlap) presets, and the preset with an explicit minimum.
PRESETS = ((1024, 100), (512, 50), (256, 25))
MIN_SIZE_PRESET = {"size": 1024, "overlap": 100, "min_len": 200}


def _blocks(df: DataFrame, keep: Sequence[str], text: str, size: int) -> DataFrame:
    blocks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return df.select(*keep, blocks.alias("__blocks"))


def _emit(df: DataFrame, keep: Sequence[str], pieces: Column, min_len: int) -> DataFrame:
    out = df.select(*keep, F.posexplode(pieces).alias("chunk_ix", "chunk"))
    return out.filter(F.length("chunk") >= min_len) if min_len > 0 else out


def chunk_lookback(df: DataFrame, size: int, overlap: int, min_len: int | None = None,
                   text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Chunk i covers [i*size - overlap, (i+1)*size); the first starts at 0.

    Chunks after the first are up to ``size + overlap`` long. Chunks shorter than
    ``min_len`` (half the size by default) are dropped.
    """
    if not 0 <= overlap <= size:
        raise ValueError("overlap must lie in 0..size")
    blocks = F.col("__blocks")
    pieces = F.transform(blocks, lambda b, i: F.when(i == 0, b).otherwise(
        F.concat(F.right(F.get(blocks, i - 1), F.lit(overlap)), b)) if overlap else b)
    return _emit(_blocks(df, keep, text, size), keep, pieces,
                 size // 2 if min_len is None else min_len)


def chunk_stride(df: DataFrame, size: int, overlap: int, min_len: int | None = None,
                 text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Chunks of ``size`` characters starting every ``size - overlap``."""
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    blocks = F.col("__blocks")
    span = -(-size // step)
    pieces = F.transform(blocks, lambda b, i: F.left(
        F.array_join(F.slice(blocks, i + 1, span), ""), F.lit(size)))
    return _emit(_blocks(df, keep, text, step), keep, pieces,
                 size // 2 if min_len is None else min_len)


def _windows(words: Column, width: int, step: int) -> Column:
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1, F.lit(step))) \
        .otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.array_join(F.slice(words, s + 1, width), " "))


def chunk_tokens(df: DataFrame, width: int = 512, overlap: int = 50, text: str = "text",
                 keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Windows of ``width`` tokens every ``width - overlap``; short tails are kept."""
    tokens = df.select(*keep, tx.words(F.col(text)).alias("__words"))
    return _emit(tokens, keep, _windows(F.col("__words"), width, width - overlap), 0)


def qa_windows(df: DataFrame, width: int = 512, stride: int = 256, text: str = "text",
               keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Word windows as question, context and answer rows."""
    tokens = df.select(*keep, tx.words(F.col(text)).alias("__words"))
    chunk = F.col("chunk")
    # Question wording and its 100- and 512-character cuts.
    question = F.concat(F.lit("Summarize the following text: "), F.left(chunk, F.lit(100)), F.lit("..."))
    return _emit(tokens, keep, _windows(F.col("__words"), width, stride), 0).select(
        *keep, F.col("chunk_ix").alias("window_ix"), question.alias("question"),
        chunk.alias("context"), F.left(chunk, F.lit(512)).alias("answer"))


def _merge(text: str, sep: str, limit: int) -> list[str]:
    out: list[str] = []
    open_piece: list[str] = []
    held = 0
    for piece in filter(None, text.split(sep)):
        joined = held + len(piece) + (len(sep) if open_piece else 0)
        if open_piece and joined > limit:
            out.append(sep.join(open_piece).strip())
            open_piece, joined = [], len(piece)
        open_piece.append(piece)
        held = joined
    out.append(sep.join(open_piece).strip())
    return [c for c in out if c]


def chunk_merge(df: DataFrame, sep: str = "\n\n", limit: int = 1000, text: str = "text",
                keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Split on ``sep`` and merge neighbours while they fit ``limit`` characters.

    A piece longer than the limit stays whole. The merge depends on a running length
    that resets, which no built-in expression computes in linear time, so it is a
    small Arrow-batched function.
    """
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def merge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: _merge(t, sep, limit) if t is not None else [])

    return _emit(df, keep, merge(F.col(text)), 0)
