"""Operator 5: token counts from distinct pre-tokens joined to per-document frequencies."""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.kernels import blocks, lists, longs
from corvane.llm.pretoken import pieces, unassigned
from corvane.llm.rows import batch, frequent, map_blocks, materialize, shared, table, texts
from corvane.ship import ship


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def _specials(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return sorted((t["content"] for t in json.load(f)["added_tokens"]), key=len, reverse=True)


def segments(values: list[str], path: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut at the added tokens of the vocabulary: (parts, text of each part, added tokens per text)."""
    import regex
    found = np.zeros(len(values), np.int64)
    specials = _specials(path)
    if not any(s in v for v in values for s in specials):
        return values, np.arange(len(values)), found
    pattern = regex.compile("|".join(map(regex.escape, specials)))
    parts, owner = [], []
    for i, value in enumerate(values):
        mine = pattern.split(value)
        found[i] = len(mine) - 1
        parts += mine
        owner += [i] * len(mine)
    return parts, np.array(owner, np.int64), found


def _library_pieces(parts: list[str], path: str):
    """The pre-tokens of :func:`pieces`, with the library's own cuts where Unicode versions may differ."""
    joined, starts, ends, owner, hashes = pieces(parts)
    odd = unassigned()
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    if odd[codes].any():
        cutter, cuts, owners, base = _tokenizer(path).pre_tokenizer, [], [], 0
        for i, part in enumerate(parts):
            spans = [s for _, s in cutter.pre_tokenize_str(part)] if part else []
            cuts += [(base + a, base + b) for a, b in spans]
            owners += [i] * len(spans)
            base += len(part)
        from corvane.llm.kernels import span_hashes
        from corvane.llm.pretoken import code_values
        starts, ends = (np.array(x, np.int64) for x in zip(*cuts)) if cuts else (np.zeros(0, np.int64),) * 2
        owner = np.array(owners, np.int64)
        hashes = span_hashes(code_values()[codes], starts, ends)
    return joined, starts, ends, owner, hashes


def distinct_pieces(source: DataFrame, path: str) -> DataFrame:
    """``piece`` (64-bit hash), ``n`` (occurrences), ``tokens``: every distinct pre-token, encoded once."""
    ship(source.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # of this task; the text of a piece leaves a task once
        for block in blocks(batches):
            parts, _, _ = segments(block.column("text").fill_null("").to_pylist(), path)
            joined, starts, ends, _, hashes = _library_pieces(parts, path)
            keys, first, n = np.unique(hashes, return_index=True, return_counts=True)
            new = [k not in sent for k in keys.tolist()]
            sent.update(keys.tolist())
            text = [joined[a:b] if x else None
                    for a, b, x in zip(starts[first].tolist(), ends[first].tolist(), new)]
            yield batch(piece=longs(keys), n=pa.array(n, pa.int64()), text=pa.array(text, pa.string()))

    def encode(block: pa.RecordBatch) -> pa.RecordBatch:
        got = _tokenizer(path).encode_batch(block.column("text").to_pylist(), add_special_tokens=False)
        return batch(piece=block.column("piece"), n=block.column("n"),
                     tokens=pa.array([len(x.ids) for x in got], pa.int64()))

    found = source.select("text").mapInArrow(count, "piece bigint, n bigint, text string")
    once = found.groupBy("piece").agg(F.sum("n").alias("n"), F.max("text").alias("text"))
    return map_blocks(once, encode, "piece bigint, n bigint, tokens bigint")


def token_counts(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of every whole text, without materialising ids.

    Pre-tokens are counted over all texts and each distinct one is encoded once. The most frequent
    2^20 at most, known from the counts, go to every task, which adds up ``frequency * tokens`` for
    them; the frequencies of the others are joined to the table of distinct pre-tokens by a shuffle
    (none of them can be a hot key, as the frequent ones are gone) and summed per row.

    Returns ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``; one row per input row. Null text: empty,
    0 tokens. Added tokens of the vocabulary inside a text count as one token each, as in the library.
    Repeated rows and null ids: kept. Other columns are not read. Empty table: empty result.
    Pre-tokens are told apart by 64-bit hashes.
    """
    source = texts(docs, key, text)
    spark = source.sparkSession
    distinct = materialize(distinct_pieces(source, path), "pieces")
    cut = frequent(distinct)
    head = shared(spark, table(distinct.filter(F.col("n") >= cut).select("piece", "tokens")))

    def sums(block: pa.RecordBatch) -> pa.RecordBatch:
        n_rows = block.num_rows
        parts, part_row, specials = segments(block.column("text").fill_null("").to_pylist(), path)
        _, _, _, owner, hashes = _library_pieces(parts, path)
        owner = part_row[owner]
        keys, which = np.unique(hashes, return_inverse=True)
        keys, known = keys.view(np.int64), head.value["piece"]
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
        tokens = np.zeros(len(keys), np.int64)
        tokens[hit] = head.value["tokens"][at[hit]]
        total = np.bincount(owner, weights=tokens[which], minlength=n_rows).astype(np.int64) + specials
        rare = np.flatnonzero(~hit[which])
        pairs, n = np.unique(owner[rare] << 32 | which[rare], return_counts=True)
        bounds = np.searchsorted(pairs >> 32, np.arange(n_rows + 1))
        return batch(doc_id=block.column("doc_id"), n_bytes=block.column("n_bytes"), head=pa.array(total, pa.int64()),
                     pieces=lists(pa.array(keys[pairs & (2 ** 32 - 1)], pa.int64()), bounds),
                     counts=lists(pa.array(n, pa.int64()), bounds))

    kind = source.schema["doc_id"].dataType.simpleString()
    sized = source.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    per_row = map_blocks(sized, sums, f"doc_id {kind}, n_bytes bigint, head bigint, "
                         "pieces array<bigint>, counts array<bigint>")
    per_row = materialize(per_row.withColumn("row", F.monotonically_increasing_id()), "frequencies")
    rare = per_row.select("row", F.explode(F.arrays_zip("pieces", "counts")).alias("p")) \
        .select("row", F.col("p.pieces").alias("piece"), F.col("p.counts").alias("k"))
    tail = rare.join(distinct.filter(F.col("n") < cut).select("piece", "tokens"), "piece") \
        .groupBy("row").agg(F.sum(F.col("k") * F.col("tokens")).alias("tail"))
    total = F.col("head") + F.coalesce("tail", F.lit(0))
    return per_row.drop("pieces", "counts").join(tail, "row", "left") \
        .select("doc_id", "n_bytes", total.cast("bigint").alias("n_tokens"), (total > limit).alias("over_limit"))
