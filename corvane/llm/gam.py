"""Operator 3: quality classifier, a generalised additive model with pairwise interactions."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.kernels import flat
from corvane.llm.measures import measures, per_row
from corvane.llm.rows import batch, map_blocks, materialize, texts

#: Labelled rows that the model is fitted on, the first by a hash of their id.
FIT_ROWS = 8192
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 200, 60, 0.1

FEATURES = ["log_words", "distinct_words", "short_words", "word_length", "symbols", "upper", "digits", "bang", "bars",
            "points", "wide", "double_lines", "repeated_words", "line_words", "white", "marked_words"]


def _flag(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _DIGIT, _BANG, _BAR = (_flag(x) for x in (bytes(range(65, 91)), bytes(range(48, 58)), b"!", b"|"))
_POINT, _MARK = _flag(b".,;:?"), _flag(b"!#*$%&|<>@~^_=+")


def features(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of numbers per text, from its characters alone; an empty text is all zeros."""
    m = {k: v.astype(np.float64) for k, v in measures(raw, off).items()}
    words, chars = np.maximum(m["n_words"], 1), np.maximum(m["n_chars"], 1)

    def share(flag: np.ndarray) -> np.ndarray:
        return per_row(flag[raw], off) / chars
    columns = [np.log1p(m["n_words"]), m["n_distinct"] / words, m["n_short"] / words, m["word_chars"] / words,
               m["n_symbols"] / chars, share(_UPPER), share(_DIGIT), share(_BANG), share(_BAR), share(_POINT),
               per_row(raw >= 0xC0, off) / chars, m["n_dup_lines"] / np.maximum(m["n_lines"], 1),
               m["n_repeat_words"] / words, m["n_words"] / np.maximum(m["n_lines"], 1),
               (m["n_chars"] - m["word_chars"]) / chars, per_row(_MARK[raw], off) / words]
    return np.column_stack(columns)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _leaves(g: np.ndarray, h: np.ndarray, leaves: int = 4, ridge: float = 1.0, least: float = 2.0) -> np.ndarray:
    """Value of each bin in a shallow tree on one binned feature: up to ``leaves`` ranges of bins."""
    cuts = [0, len(g)]
    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])

    def worth(a, b):
        return (gs[b] - gs[a]) ** 2 / (hs[b] - hs[a] + ridge)
    while len(cuts) - 1 < leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            at = np.arange(a + 1, b)
            at = at[(hs[at] - hs[a] >= least * 0.1) & (hs[b] - hs[at] >= least * 0.1)]
            if len(at):
                gain = worth(a, at) + worth(at, b) - worth(a, b)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), int(at[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """(gain, value of each cell) of the best cut of a two-feature table into four."""
    gs, hs = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    n, m = g.shape
    i, j = np.arange(1, n)[:, None], np.arange(1, m)[None, :]

    def block(s, part):
        return {0: s[i, j], 1: s[i, m] - s[i, j], 2: s[n, j] - s[i, j],
                3: s[n, m] - s[i, m] - s[n, j] + s[i, j]}[part]
    gain = sum(block(gs, p) ** 2 / (block(hs, p) + ridge) for p in range(4)) - gs[n, m] ** 2 / (hs[n, m] + ridge)
    a, b = np.unravel_index(int(gain.argmax()), gain.shape)
    value = np.zeros((n, m))
    for part, (rows, cols) in enumerate([(slice(0, a + 1), slice(0, b + 1)), (slice(0, a + 1), slice(b + 1, m)),
                                         (slice(a + 1, n), slice(0, b + 1)), (slice(a + 1, n), slice(b + 1, m))]):
        value[rows, cols] = block(gs, part)[a, b] / (block(hs, part)[a, b] + ridge)
    return float(gain[a, b]), value


@dataclass
class Model:
    """Intercept, one table per feature, one per pair of features; a score adds the looked-up cells."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)]
        out = np.full(len(x), self.intercept)
        for table, b in zip(self.tables, bins):
            out += table[b]
        for i, j, table in self.pairs:
            out += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: every round visits each feature in turn, then the chosen pairs, with a small tree each.

    Without rows of both labels the model is the smoothed share of label 1.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0)
             for k in range(x.shape[1])]
    model = Model(edges, float(np.log(share / (1 - share))), [np.zeros(len(e) + 1) for e in edges])
    model.coarse = [np.arange(len(e) + 1) * PAIR_BINS // (len(e) + 1) for e in edges]
    if len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)]
    margin = np.full(len(y), model.intercept)

    def residual():
        p = _sigmoid(margin)
        return y - p, p * (1 - p)
    for _ in range(ROUNDS):
        for k, b in enumerate(bins):
            g, h = residual()
            size = len(edges[k]) + 1
            step = RATE * _leaves(np.bincount(b, g, size), np.bincount(b, h, size))
            model.tables[k] += step
            margin += step[b]
    coarse = [c[b] for c, b in zip(model.coarse, bins)]

    def cells(i, j, weights):
        return np.bincount(coarse[i] * PAIR_BINS + coarse[j], weights, PAIR_BINS ** 2).reshape(PAIR_BINS, PAIR_BINS)
    g, h = residual()
    ranked = sorted(((_quadrants(cells(i, j, g), cells(i, j, h))[0], i, j)
                     for i in range(len(bins)) for j in range(i)), reverse=True)[:PAIRS]
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            g, h = residual()
            step = RATE * _quadrants(cells(i, j, g), cells(i, j, h))[1]
            table += step
            margin += step[coarse[i], coarse[j]]
    return model


def held_out(key: str = "doc_id"):
    """Whether crc32 of the id as text is divisible by 5; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents outside the held-out fold, the first by a hash of their id.

    Repeated labels of an id count once, by their least value; null labels do not count.
    """
    known = labels.select("doc_id", F.col("quality").cast("double").alias("y")).dropna() \
        .groupBy("doc_id").agg(F.min("y").alias("y")).filter(~held_out())
    chosen = materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "sample")
    sample = docs.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "text"]) \
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(rows)

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        x = features(*flat(block.column("text")))
        bounds = np.arange(len(x) + 1) * x.shape[1]
        return batch(y=block.column("y"), x=pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x.ravel())))

    narrow = sample.select("doc_id", "text", "y")
    got = map_blocks(narrow, kernel, "y double, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, got.column("y").to_numpy())


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Score every whole text with the model learnt from ``labels``.

    Returns ``doc_id``, ``held_out``, ``score``, ``predicted``; one row per input row, in one pass without a shuffle.
    Only characters of the text enter a score. Null text: as an empty one, which is scored too.
    Repeated rows and null ids: kept. Other columns are not read. No labels: one constant score.
    """
    source = texts(docs, key, text)
    model = train(source, labels)

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        s = model.score(features(*flat(block.column("text"))))
        return batch(doc_id=block.column("doc_id"), score=pa.array(s, pa.float64()))

    kind = source.schema["doc_id"].dataType.simpleString()
    scored = map_blocks(source, kernel, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
