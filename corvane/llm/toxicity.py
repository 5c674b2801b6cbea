"""Operator 12: toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.gam import held_out
from corvane.llm.kernels import mix, span_hashes
from corvane.llm.pretoken import LETTER, NUMBER, SPACE, classes, code_points, code_values
from corvane.llm.rows import batch, map_blocks, materialize, texts

#: Labelled documents of each class that the machine is fitted on, the first by a hash of their id.
FIT_ROWS = 4096
LANDMARKS, ROUNDS, CANDIDATES = 384, 3, 1024
#: Weight of a subsequence falls by this factor for each skipped character; at most ``SKIPS`` are skipped.
DECAY, SKIPS = 0.5, 2
#: Longest word that may become an example or a landmark.
EXAMPLE_CHARS = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BREAKS = ".,;:!?|/"
_FIRST, _LAST = 1, 2  # control characters stand for the ends of a word
_FILTER_BITS = 20

#: Offsets of the characters of every subsequence of three or four characters, with its skipped ones.
PATTERNS = [((0, *inner, last), last + 1 - size) for size in (3, 4) for last in range(size - 1, size + SKIPS)
            for inner in combinations(range(1, last), size - 2)]


@dataclass
class Words:
    """Words of a block of texts: padded code points of each, its text number and 64-bit hash."""

    codes: np.ndarray
    ptr: np.ndarray
    owner: np.ndarray
    hashes: np.ndarray

    def take(self, at: np.ndarray) -> "Words":
        sizes = self.ptr[at + 1] - self.ptr[at]
        ptr = np.append(0, np.cumsum(sizes))
        codes = self.codes[np.arange(ptr[-1]) + np.repeat(self.ptr[at] - ptr[:-1], sizes)]
        return Words(codes, ptr, self.owner[at], self.hashes[at])

    def written(self, at: int) -> str:
        return "".join(map(chr, self.codes[self.ptr[at] + 1:self.ptr[at + 1] - 1].tolist()))


def words(values: list[str]) -> Words:
    """Lower-cased words of letters and digits.

    White space and stops end a word, other characters are passed over, so ``st*pid`` is one word;
    three or more single characters in a row, however parted, are one word too.
    """
    _, codes, offsets = code_points([v.lower() for v in values])
    kind = classes()[codes]
    kept = np.flatnonzero((kind == LETTER) | (kind == NUMBER))
    stop = (kind == SPACE) | np.isin(codes, [ord(c) for c in _BREAKS])
    stops = np.append(0, np.cumsum(stop))
    row = np.searchsorted(offsets, kept, side="right") - 1
    starts = np.ones(len(kept), bool)
    starts[1:] = (stops[kept[1:]] != stops[kept[:-1]]) | (row[1:] != row[:-1])
    first = np.flatnonzero(starts)
    single = np.diff(np.append(first, len(kept))) == 1
    joins = np.zeros(len(first), bool)  # goes on with the word before
    joins[1:] = single[1:] & single[:-1] & (row[first[1:]] == row[first[:-1]])
    run = np.cumsum(~joins)
    long_run = np.bincount(run, minlength=run[-1] + 1 if len(run) else 1) >= 3
    starts[first[joins & long_run[run]]] = False
    first = np.flatnonzero(starts)
    sizes = np.diff(np.append(first, len(kept)))
    ptr = np.append(0, np.cumsum(sizes + 2))
    padded = np.full(ptr[-1], _FIRST, np.uint32)
    padded[ptr[1:] - 1] = _LAST
    padded[np.arange(len(kept)) + 2 * (np.cumsum(starts) - 1) + 1] = codes[kept]
    hashes = span_hashes(code_values()[padded], ptr[:-1], ptr[1:]) if len(first) else np.zeros(0, np.uint64)
    return Words(padded, ptr, row[first], hashes)


def subsequences(w: Words):
    """(word, 64-bit hash, weight) of every subsequence, pattern by pattern."""
    values = code_values()[w.codes]
    owner = np.repeat(np.arange(len(w.ptr) - 1), np.diff(w.ptr))
    ends = np.repeat(w.ptr[1:], np.diff(w.ptr))
    place = np.arange(len(values))
    for offsets, skipped in PATTERNS:
        at = np.flatnonzero(place + offsets[-1] < ends)
        total = np.full(len(at), len(offsets), np.uint64)
        for o in offsets:
            total = total * _ODD + values[at + o]
        yield owner[at], mix(total), DECAY ** skipped


def norms(w: Words) -> np.ndarray:
    """Root of the summed squared weights of a word's subsequences, which only depends on its length."""
    n = np.diff(w.ptr)
    total = sum(np.maximum(n - offsets[-1], 0) * DECAY ** (2 * skipped) for offsets, skipped in PATTERNS)
    return np.sqrt(np.maximum(total, 1e-9))


class Landmarks:
    """Subsequence weights of the landmark words, and the Nyström map of other words onto them."""

    def __init__(self, chosen: list[str]):
        w = examples(chosen)
        parts = list(subsequences(w))
        owner = np.concatenate([p[0] for p in parts])
        hashes = np.concatenate([p[1] for p in parts])
        weights = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
        self.hashes, which = np.unique(hashes, return_inverse=True)
        self.table = np.zeros((len(self.hashes), len(chosen)))
        np.add.at(self.table, (which, owner), weights / norms(w)[owner])
        values, vectors = np.linalg.eigh(self.kernel(w))
        big = values > 1e-6 * max(values.max(), 1e-6)
        self.root = vectors[:, big] / np.sqrt(values[big])

    def kernel(self, w: Words, step: int = 2048) -> np.ndarray:
        """Kernel values of each word with each landmark."""
        n = len(w.ptr) - 1
        out = np.zeros((n, self.table.shape[1]))
        for low in range(0, n, step):
            part = w.take(np.arange(low, min(low + step, n)))
            for owner, hashes, weight in subsequences(part):
                at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
                hit = np.flatnonzero(self.hashes[at] == hashes)
                if len(hit):  # owners ascend, so each word's rows are summed as one run
                    runs = np.flatnonzero(np.append(True, np.diff(owner[hit])))
                    out[low + owner[hit[runs]]] += weight * np.add.reduceat(self.table[at[hit]], runs)
        return out / norms(w)[:, None]

    def features(self, w: Words) -> np.ndarray:
        return self.kernel(w) @ self.root


def examples(chosen: list[str]) -> Words:
    """Words as they are, one for each string."""
    codes = [np.array([_FIRST, *map(ord, x), _LAST], np.uint32) for x in chosen]
    ptr = np.append(0, np.cumsum([len(c) for c in codes])).astype(np.int64)
    flat = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    hashes = span_hashes(code_values()[flat], ptr[:-1], ptr[1:]) if codes else np.zeros(0, np.uint64)
    return Words(flat, ptr, np.arange(len(chosen)), hashes)


def _machine(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps on the violating rows."""
    x = np.column_stack([z, np.ones(len(z))])
    keep = np.append(np.full(z.shape[1], ridge), ridge * 1e-3)
    v = np.zeros(x.shape[1])
    for _ in range(30):
        short = 1 - y * (x @ v) > 0
        a = x[short] * weight[short, None]
        new = np.linalg.solve(a.T @ x[short] + np.diag(keep), a.T @ y[short])
        done = np.abs(new - v).max() < 1e-9
        v = new
        if done:
            break
    return v[:-1], float(v[-1])


@dataclass
class Model:
    """Weight of each subsequence, bias, and the logistic curve from a text's margins to its score."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -1.0
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def __post_init__(self):
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[(self.hashes & np.uint64(len(self.bits) - 1)).astype(np.int64)] = True

    def word_margins(self, w: Words) -> np.ndarray:
        """Signed distance of each word, the sum of its subsequences' weights by its norm."""
        total = np.zeros(len(w.ptr) - 1)
        for owner, hashes, weight in subsequences(w):
            some = np.flatnonzero(self.bits[(hashes & np.uint64(len(self.bits) - 1)).astype(np.int64)])
            found = hashes[some]
            at = np.minimum(np.searchsorted(self.hashes, found), max(len(self.hashes) - 1, 0))
            hit = self.hashes[at] == found if len(self.hashes) else np.zeros(len(found), bool)
            total += np.bincount(owner[some[hit]], weights=weight * self.weights[at[hit]], minlength=len(total))
        return total / norms(w) + self.bias

    def texts(self, values: list[str]) -> tuple[np.ndarray, np.ndarray, list[str | None]]:
        """(largest word margin, sum of positive ones, that word) of each text; without words the bias alone."""
        every = words(values)
        keys, first, which = np.unique(every.hashes, return_index=True, return_inverse=True)
        distinct = every.take(first)
        margin = self.word_margins(distinct)
        top, rest = np.full(len(values), self.bias), np.zeros(len(values))
        worst: list[str | None] = [None] * len(values)
        if len(which):
            each = margin[which]
            bounds = np.flatnonzero(np.append(True, every.owner[1:] != every.owner[:-1]))
            rows = every.owner[bounds]
            top[rows] = np.maximum.reduceat(each, bounds)
            rest = np.bincount(every.owner, weights=np.maximum(each, 0), minlength=len(values))
            where = np.flatnonzero(each == top[every.owner])
            rows, at = np.unique(every.owner[where], return_index=True)
            for r, i in zip(rows.tolist(), which[where[at]].tolist()):
                worst[r] = distinct.written(i)
        return top, rest, worst

    def score(self, top: np.ndarray, rest: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a * np.clip(top, -3, 3) + b * np.log1p(rest) + c, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    v = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(v))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * v)
        v = v + step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return v


def fit(positive: dict[str, float], negative: dict[str, float]) -> Model:
    """Machine on weighted example words; both classes weigh the same. Landmarks are the heaviest words of each class."""
    pos, neg = (sorted(x, key=lambda word: (-x[word], word)) for x in (positive, {k: v for k, v in negative.items() if k not in positive}))
    chosen = pos[:LANDMARKS // 2] + neg[:LANDMARKS - min(len(pos), LANDMARKS // 2)]
    marks = Landmarks(chosen)
    every = pos + neg
    y = np.append(np.ones(len(pos)), -np.ones(len(neg)))
    weight = np.array([positive[w] for w in pos] + [negative[w] for w in neg], np.float64)
    for sign in (1, -1):
        weight[y == sign] /= max(weight[y == sign].sum(), 1e-9)
    v, bias = _machine(marks.features(examples(every)), y, weight)
    weights = marks.table @ (marks.root @ v)
    used = weights != 0
    return Model(marks.hashes[used], weights[used], bias)


def _examine(sample: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str | None]]:
    """(label, largest margin, sum of positive margins, worst word) of each document of the bounded sample."""
    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        top, rest, worst = model.texts(block.column("text").fill_null("").to_pylist())
        short = [w if w and len(w) <= EXAMPLE_CHARS else None for w in worst]
        return batch(y=block.column("y"), top=pa.array(top), rest=pa.array(rest), worst=pa.array(short, pa.string()))

    got = map_blocks(sample.select("text", "y"), kernel, "y double, top double, rest double, worst string").toArrow()
    return (*[got.column(c).to_numpy() for c in ("y", "top", "rest")], got.column("worst").to_pylist())


def _first_examples(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words that speak most for either class, by the likelihood ratio of the documents that hold them."""
    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        w = words(block.column("text").fill_null("").to_pylist())
        keys, which = np.unique(w.hashes, return_inverse=True)
        pairs = np.unique(w.owner * max(len(keys), 1) + which, return_index=True)[1]
        pairs = pairs[w.ptr[pairs + 1] - w.ptr[pairs] <= EXAMPLE_CHARS + 2]
        y = block.column("y").to_numpy()[w.owner[pairs]]
        return batch(word=pa.array([w.written(i) for i in pairs.tolist()], pa.string()), y=pa.array(y, pa.float64()))

    found = map_blocks(sample.select("text", "y"), kernel, "word string, y double")
    counts = materialize(found.groupBy("word").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")), "examples")
    size = sample.agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).first()
    if not size["t"] or not size["c"]:
        return {}, {}
    odds = F.log((F.col("t") + 0.5) / (size["t"] + 1)) - F.log((F.col("c") + 0.5) / (size["c"] + 1))
    marked = counts.withColumn("g", (F.col("t") + F.col("c")) * odds)
    top = marked.filter("g > 0 and t >= 2 and t > 4 * c").orderBy(F.desc("g"), "word").limit(CANDIDATES).collect()
    plain = counts.filter("t <= c").orderBy(F.xxhash64("word"), "word").limit(4 * CANDIDATES).collect()
    return {r["word"]: r["g"] for r in top}, {r["word"]: 1.0 for r in plain}


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents of each class outside the held-out fold, the first by a hash of their id.

    A toxic document is a bag of words of which one at least is toxic: each round takes the word of
    largest margin of every toxic document as a positive example and that of every clean document as
    a negative one, and fits again. Repeated labels of an id count once, by their least value; equal texts count once.
    """
    known = labels.select("doc_id", F.col("toxic").cast("double").alias("y")).dropna() \
        .groupBy("doc_id").agg(F.min("y").alias("y")).filter(~held_out()).filter("y in (0, 1)")
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = (totals.get(1.0, 0) + 1) / (sum(totals.values()) + 2)
    constant = Model(curve=(0.0, 0.0, float(np.log(share / (1 - share)))))
    if len(totals) < 2:
        return constant
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.filter(F.col("y") == y).orderBy(*order).limit(rows) for y in (0.0, 1.0)]
    chosen = materialize(chosen[0].unionByName(chosen[1]), "chosen")
    sample = docs.join(F.broadcast(chosen), "doc_id").select("text", "y").dropna().dropDuplicates(["text"])
    sample = materialize(sample.repartition(4 * docs.sparkSession.sparkContext.defaultParallelism), "sample")
    positive, negative = _first_examples(sample)
    if not positive or not negative:
        return constant
    plain = dict(negative)
    model = fit(positive, negative)
    for last in range(ROUNDS):
        y, top, rest, worst = _examine(sample, model)
        if last == ROUNDS - 1 or not (y == 1).any() or not (y == 0).any():
            break
        positive, hard = {}, {}
        for label, margin, word in zip(y.tolist(), top.tolist(), worst):
            if word and (label == 0 or margin > -1):
                side = positive if label else hard
                side[word] = side.get(word, 0.0) + 1
        # A word that speaks for both classes counts for the one it is found in more often, by share.
        scale = (y == 1).sum() / (y == 0).sum()
        positive = {w: n for w, n in positive.items() if n > 2 * scale * hard.get(w, 0)}
        if not positive:
            break
        for word, n in hard.items():
            if word not in positive:
                negative[word] = negative.get(word, 0.0) + n
        model = fit(positive, {**plain, **negative})
    weight = np.where(y == 1, totals[1.0] / max((y == 1).sum(), 1), totals[0.0] / max((y == 0).sum(), 1))
    weight = weight / weight.mean()
    x = np.column_stack([np.clip(top, -3, 3), np.log1p(rest), np.ones(len(y))])
    model.curve = tuple(float(v) for v in _logistic(x, y, weight))
    return model


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every whole text for toxicity with the machine learnt from ``labels``.

    The kernel of two words sums the products of the weights of their common subsequences of three and
    four characters, word ends included, with up to two characters skipped. A machine on Nyström
    features is linear in the subsequences of the landmarks, so a word is scored by looking up its own.

    Returns ``doc_id``, ``held_out``, ``score``, ``predicted``, ``worst`` (the word of largest margin), ``margin``; one
    row per input row, in one pass without a shuffle. Only characters of the text enter a score. Null
    text: as an empty one, which is scored too. Very long texts: whole. Repeated rows and null ids: kept.
    Ties: the first word. Other columns are not read. No labels of both classes: one constant score.
    """
    source = texts(docs, key, text)
    model = train(source, labels)

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        top, rest, worst = model.texts(block.column("text").fill_null("").to_pylist())
        return batch(doc_id=block.column("doc_id"), score=pa.array(model.score(top, rest), pa.float64()),
                     worst=pa.array(worst, pa.string()), margin=pa.array(top, pa.float64()))

    kind = source.schema["doc_id"].dataType.simpleString()
    scored = map_blocks(source, kernel, f"doc_id {kind}, score double, worst string, margin double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "worst", "margin")
