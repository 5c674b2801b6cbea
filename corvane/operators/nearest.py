"""Scores of vectors and the best rows per query inside one task."""

from __future__ import annotations

import numpy as np
import pandas as pd

# Largest score matrix held at once, in values.
SCORE_VALUES = 8_000_000
# A cosine from a matrix product may differ by this much from the same cosine in another block.
_ROUNDING = 1e-9


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.vstack(vectors.to_numpy()).astype(np.float64)


def scores(queries: np.ndarray, corpus: np.ndarray, metric: str) -> np.ndarray:
    """Larger is nearer."""
    if metric == "cosine":
        qn = np.linalg.norm(queries, axis=1, keepdims=True)
        cn = np.linalg.norm(corpus, axis=1)
        dots = queries @ corpus.T
        norms = qn * cn
        return np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)
    out = np.empty((len(queries), len(corpus)))
    for i, q in enumerate(queries):
        diff = q - corpus
        out[i] = -np.einsum("ij,ij->i", diff, diff)
    return out


def _cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Row by row, so that equal rows have equal scores whatever else is in the block."""
    dots = np.einsum("ij,j->i", rows, query)
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows)) * np.sqrt(np.einsum("i,i->", query, query))
    return np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)


def _best(held: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties by id."""
    if len(held) > k:
        edge = np.partition(held, len(held) - k)[len(held) - k]
        kept = np.flatnonzero(held >= edge)
    else:
        kept = np.arange(len(held))
    return kept[np.lexsort((ids[kept], -held[kept]))][:k]


class Best:
    """The k nearest rows per query of all that one task has been offered."""

    def __init__(self, qids: np.ndarray, k: int):
        self.qids, self.k = qids, k
        self.held = [(np.empty(0), np.empty(0, dtype=object))] * len(qids)
        self.edge = np.full(len(qids), -np.inf)     # k-th best score so far

    def offer(self, who: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, metric: str) -> None:
        """Rows for the queries at the positions ``who``."""
        step = max(1, SCORE_VALUES // len(ids))
        for first in range(0, len(who), step):
            at = who[first:first + step]
            found = scores(queries[at], vectors, metric)
            slack = _ROUNDING if metric == "cosine" else 0.0
            for j in np.flatnonzero(found.max(axis=1) >= self.edge[at] - slack):
                i, new, new_ids = at[j], found[j], ids
                if metric == "cosine":
                    cut = np.partition(new, len(new) - self.k)[len(new) - self.k] if len(new) > self.k else -np.inf
                    near = np.flatnonzero(new >= max(cut, self.edge[i]) - slack)
                    new, new_ids = _cosines(queries[i], vectors[near]), ids[near]
                held = np.concatenate([self.held[i][0], new])
                held_ids = np.concatenate([self.held[i][1], new_ids])
                top = _best(held, held_ids, self.k)
                self.held[i] = (held[top], held_ids[top])
                if len(top) == self.k:
                    self.edge[i] = held[top[-1]]

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame({
            "__q": np.repeat(self.qids, [len(b[0]) for b in self.held]),
            "__id": np.concatenate([b[1] for b in self.held]) if self.held else [],
            "__s": np.concatenate([b[0] for b in self.held]) if self.held else []})
