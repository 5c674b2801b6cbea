"""Operator 9: byte-level BPE encoding and decoding in length-bucketed numpy matrices."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corvane.llm import bpe
from corvane.llm.pretoken import pieces
from corvane.llm.rows import batch, map_blocks, texts

#: Pieces a task remembers between blocks; a full memory is emptied, which costs time only.
MEMORY = 100_000


class Encoder:
    """Encodes blocks of texts; each distinct pre-token of a block is merged once."""

    def __init__(self, path: str):
        self.vocabulary = bpe.load(path)
        self.known: dict[str, np.ndarray] = {}

    def distinct(self, texts_: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """(ids of each distinct pre-token, which one each pre-token is, text of each pre-token)."""
        joined, starts, ends, owner, hashes = pieces(texts_)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        words = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        if len(self.known) > MEMORY:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        self.known.update(zip(new, self.vocabulary.encode([w.encode() for w in new])))
        return [self.known[w] for w in words], which, owner


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Token ids of every whole text, and the bytes that they decode to.

    Returns ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by blanks), ``decoded_sha256``
    and, if asked for, ``ids`` and ``decoded``. One row per input row, in one pass without a shuffle.
    Null text: as an empty one, no tokens. Long texts and pieces: whole, in memory bounded by the text.
    Repeated rows, null ids: kept as they are. Other columns are not read. Empty table: empty result.
    """
    extra = ", ids array<int>, decoded binary" if ids else ""

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _encoder(path)
        values = block.column("text").fill_null("").to_pylist()
        each, which, owner = encoder.distinct(values)
        token = encoder.vocabulary.tokens
        written = [" ".join(map(str, x.tolist())) for x in each]
        decoded = [b"".join([token[i] for i in x.tolist()]) for x in each]
        sizes = np.array([len(x) for x in each], np.int64)[which]
        counts = np.bincount(owner, weights=sizes, minlength=len(values)).astype(np.int64)
        bounds = np.searchsorted(owner, np.arange(len(values) + 1)).tolist()
        which = which.tolist()
        ids_sha, text_sha, all_ids, all_bytes = [], [], [], []
        for a, b in zip(bounds, bounds[1:]):
            mine = which[a:b]
            ids_sha.append(hashlib.sha256(" ".join([written[i] for i in mine]).encode()).hexdigest())
            whole = b"".join([decoded[i] for i in mine])
            text_sha.append(hashlib.sha256(whole).hexdigest())
            if ids:
                all_ids.append(np.concatenate([each[i] for i in mine]) if mine else np.zeros(0, np.int32))
                all_bytes.append(whole)
        out = {"doc_id": block.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
               "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
        if ids:
            out |= {"ids": pa.array(all_ids, pa.list_(pa.int32())), "decoded": pa.array(all_bytes, pa.binary())}
        return batch(**out)

    source = texts(docs, key, text)
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_blocks(source, kernel,
                      f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}")


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
