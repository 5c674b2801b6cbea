"""Operator 10: quality rules with perplexity bands of a modified Kneser-Ney model of byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.kernels import COUNT_BYTES, blocks, flat
from corvane.llm.measures import measures
from corvane.llm.rows import (TABLE_ENTRIES, batch, fresh, histogram, least_count, map_blocks, materialize,
                              shared, table)
from corvane.scale import fits_broadcast, lookup_join
from corvane.ship import ship

ORDER = 5
_START = 0x0A  # a text is read as if line feeds stood before it
FENCE = 3.0  # quartile distances: what Tukey (1977) calls far out, 4.7 deviations of a normal distribution
_STEPS = 1000  # bands are set on log perplexities in steps of one thousandth


def grams(raw: np.ndarray, off: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram that ends at each byte, row of the byte); bytes are packed into an integer."""
    n = len(off) - 1
    pad = order - 1
    stream = np.full(len(raw) + pad * n, _START, np.uint8)
    rows = np.repeat(np.arange(n), np.diff(off))
    at = np.arange(len(raw)) + pad * (rows + 1)
    stream[at] = raw
    packed = np.zeros(max(len(stream) - pad, 0), np.int64)
    for i in range(order):
        packed = packed << 8 | stream[i:len(packed) + i]
    return packed[at - pad], rows


def _runs(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, int)
    return sorted_[first], np.diff(np.append(first, len(sorted_)))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, their summed counts) of several tables."""
    keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(which, weights=np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)


def count_grams(docs: DataFrame, text: str = "text", order: int = ORDER) -> DataFrame:
    """``gram``, ``n``: how often each byte n-gram occurs in all texts; summed in the tasks before the shuffle."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for block in blocks(batches, max_bytes=COUNT_BYTES):
            packed, _ = grams(*flat(block.column("text")), order)
            packed.sort()
            parts.append(_runs(packed))
            if sum(len(keys) for keys, _ in parts) > 2 * TABLE_ENTRIES:
                parts = [_summed(parts)]
                if len(parts[0][0]) > TABLE_ENTRIES:
                    yield batch(gram=pa.array(parts[0][0]), n=pa.array(parts[0][1]))
                    parts = []
        if parts:
            keys, sums = _summed(parts)
            yield batch(gram=pa.array(keys), n=pa.array(sums))

    found = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(count, "gram bigint, n bigint")
    return found.groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """The three discounts of modified Kneser-Ney from the counts of counts; 0.5, 1, 1.5 where those are too thin."""
    if min(n1, n2, n3, n4) == 0:
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw)]


class Model:
    """Interpolated probabilities in sorted arrays of packed n-grams; one level per order.

    ``levels[k]``: (n-grams of k + 1 bytes, their discounted share, contexts, weight of the lower order).
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    def log_probability(self, packed: np.ndarray) -> np.ndarray:
        """Natural log of the probability of the last byte of each n-gram after the bytes before it."""
        p = np.full(len(packed), 1 / 256)
        for k, (keys, share, contexts, lower) in enumerate(self.levels):
            key = packed & ((1 << 8 * (k + 1)) - 1)
            p = _find(contexts, lower, key >> 8, 1.0) * p + _find(keys, share, key, 0.0)
        return np.log(p)


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def gram_levels(docs: DataFrame, text: str = "text", order: int = ORDER) -> list[tuple[DataFrame, list[float], dict[int, int]]]:
    """(``gram``, ``n``; discounts; histogram of ``n``) of each order, the highest first; lower ones count distinct left neighbours."""
    counts = materialize(count_grams(docs, text, order), "grams")
    levels = []
    for k in range(order, 0, -1):
        of = histogram(counts)
        levels.append((counts, discounts(*[of.get(i, 0) for i in (1, 2, 3, 4)]), of))
        if k > 1:
            shorter = F.col("gram").bitwiseAND((1 << 8 * (k - 1)) - 1)
            counts = materialize(counts.groupBy(shorter.alias("gram")).agg(F.count("*").alias("n")), "grams")
    return levels


def _discount(d: list[float]) -> Column:
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def gram_scores(docs: DataFrame, text: str = "text", order: int = ORDER) -> tuple[DataFrame, dict[int, int]]:
    """(``gram``, ``n``, ``score``; histogram of ``n``): natural log of the probability of every n-gram that the texts hold.

    The whole interpolated model, one join per order, built upwards: an n-gram meets its context, which has 256
    successors at most, and its suffix, which has 256 predecessors at most, so no key is hot and nothing is cut.
    """
    levels = gram_levels(docs, text, order)
    lower = None
    for k, (counts, d, _) in enumerate(reversed(levels), 1):
        context = F.shiftright("gram", 8)
        kinds = [F.col("n") == 1, F.col("n") == 2, F.col("n") > 2]
        freed = reduce(Column.__add__, [F.sum(kind.cast("bigint")) * x for kind, x in zip(kinds, d)])
        contexts = counts.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), freed.alias("freed"))
        met = counts.withColumn("context", context).join(contexts, "context")
        if lower is None:
            met = met.withColumn("p", F.lit(1 / 256))
        else:
            met = met.withColumn("shorter", F.col("gram").bitwiseAND((1 << 8 * (k - 1)) - 1)).join(lower, "shorter")
        p = (F.col("n") - _discount(d) + F.col("freed") * F.col("p")) / F.col("total")
        score = F.log("p").alias("score") if k == len(levels) else F.col("p")
        made = materialize(met.select("gram", "n", p.alias("p")).select("gram", "n", score), "probabilities")
        lower = made.select(F.col("gram").alias("shorter"), made.columns[2])
    return made, levels[0][2]


def train(docs: DataFrame, text: str = "text", order: int = ORDER, entries: int = TABLE_ENTRIES) -> Model:
    """A model small enough for one process, for n-grams the texts need not hold; :func:`quality` does not use it.

    Of each order the most frequent n-grams, at most ``entries``, stay in the arrays; the mass of the others
    goes to the lower order of their context, so probabilities still sum to one. What reaches the driver is
    bounded by ``entries``. The whole model over the n-grams of the texts is :func:`gram_scores`.
    """
    levels = []
    for counts, d, of in gram_levels(docs, text, order):
        cut = least_count(of, entries)
        context = F.shiftright("gram", 8)
        used = F.sum(F.when(F.col("n") >= cut, F.col("n") - _discount(d)))
        contexts = table(counts.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), used.alias("used"))
                         .filter("used is not null"), entries)
        kept = table(counts.filter(F.col("n") >= cut).select("gram", "n", (F.col("n") - _discount(d)).alias("less")), entries)
        total = contexts["total"][np.searchsorted(contexts["context"], kept["gram"] >> 8)] if len(kept["gram"]) \
            else np.zeros(0)
        levels.append((kept["gram"], kept["less"] / total, contexts["context"],
                       1 - contexts["used"] / contexts["total"]))
    return Model(levels[::-1])


def bands(scored: DataFrame, fence: float = FENCE) -> DataFrame:
    """``lang``, ``low``, ``high``: Tukey's outer fences, ``fence`` quartile distances outside each language's quartiles.

    Quartiles come from a histogram per language in steps of 1/1000, so no group is gathered; their distance
    counts as one step at least.
    """
    step = F.round(F.col("log_perplexity") * _STEPS).cast("bigint").alias("step")
    steps = scored.select("lang", step).groupBy("lang", "step").agg(F.count("*").alias("n"))
    w = Window.partitionBy("lang")
    up = w.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    seen = steps.withColumns({"seen": F.sum("n").over(up), "all": F.sum("n").over(w)})
    quartile = {q: F.min(F.when(F.col("seen") * 4 >= F.col("all") * q, F.col("step"))) for q in (1, 3)}
    ends = seen.groupBy("lang").agg(quartile[1].alias("q1"), quartile[3].alias("q3"))
    reach = F.greatest(F.col("q3") - F.col("q1"), F.lit(1)) * fence
    return ends.select("lang", ((F.col("q1") - reach) / _STEPS).alias("low"),
                       ((F.col("q3") + reach) / _STEPS).alias("high"))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``text``: every text of ``docs`` once. Only texts whose hash occurs again are shuffled."""
    body = F.col(f"`{text}`").cast("string")
    keyed = docs.select(body.alias("text"), F.xxhash64(body).alias("key"))
    again = materialize(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "again")
    if again.isEmpty():
        return keyed.select("text")
    small = fits_broadcast(again)[1]
    names = F.broadcast(again) if small else again
    repeated = keyed.join(names, "key", "left_semi").select("text").distinct()
    return keyed.join(names, "key", "left_anti").select("text").unionByName(repeated)


def quality(docs: DataFrame, fence: float = FENCE, order: int = ORDER,
            min_words: int = 50, text: str = "text", lang: str = "lang", prefix: str = "",
            entries: int = TABLE_ENTRIES) -> DataFrame:
    """All columns of ``docs`` but the text, with the base counts, ``log_perplexity``, ``base_failed`` and ``kept``.

    The model is counted over all distinct texts and scores with every n-gram it has: the most frequent ones, at
    most ``entries``, inside the tasks, the others by a shuffled join; ``entries`` changes no score. Distinct texts that pass the base rules set the band of
    their language; rows inside it are kept. The band ends ``fence`` quartile distances outside the quartiles
    of the log perplexities, on both sides: noise lies above it, repetition below. Exact copies count once
    in model and band, so they change no verdict.
    ``prefix`` is put before the new names; a column of ``docs`` that bears a new name is replaced.

    Null text: as an empty one (no words, so the base rules fail it). Null language: a language of its
    own. Repeated rows: kept, each judged alike. Empty table: empty result.
    """
    of = fresh(docs, "__hash")
    return _judged(_scored(docs, text, order, min_words, prefix, of, entries), fence, prefix, lang, of)


def keep(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, as they are. A verdict depends on text and language only."""
    name = fresh(docs, "__verdict")
    body, tongue = F.col(f"`{text}`").cast("string"), F.col(f"`{lang}`").cast("string")
    key = F.xxhash64(F.lit(10), body, F.lit(10), tongue)
    judged = quality(docs.select(body.alias("text"), tongue.alias("lang"), key.alias("of")))
    kept = materialize(judged.filter("kept").select(F.col("of").alias(name)).distinct(), "kept")
    return docs.withColumn(name, key).join(kept, name, "left_semi").select(*docs.columns)


def _row_grams(raw: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct n-grams, which of them ends at each byte, row of the byte)."""
    packed, rows = grams(raw, off, order)
    distinct, which = np.unique(packed, return_inverse=True)
    return distinct, which, rows


def _rest(once: DataFrame, scores: DataFrame, head, cut: int, order: int) -> DataFrame:
    """``of`` (hash of a text), ``rest``: summed scores of the n-grams of each text that are not in ``head``."""

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        raw, off = flat(block.column("text"))
        distinct, which, rows = _row_grams(raw, off, order)
        rare = ~np.isin(distinct, head.value[0], assume_unique=True)
        at = np.flatnonzero(rare[which])
        pair, n = np.unique(rows[at] * len(distinct) + which[at], return_counts=True)
        row, gram = np.divmod(pair, max(len(distinct), 1))
        return batch(of=block.column("of").take(pa.array(row)), gram=pa.array(distinct[gram]), m=pa.array(n, pa.int64()))

    keyed = once.select("text", F.xxhash64("text").alias("of"))
    found = map_blocks(keyed, kernel, "of bigint, gram bigint, m bigint", max_bytes=COUNT_BYTES)
    rare = scores.filter(F.col("n") < cut).select("gram", "score")
    return found.join(rare, "gram").groupBy("of").agg(F.sum(F.col("m") * F.col("score")).alias("rest"))


def _scored(docs: DataFrame, text: str, order: int, min_words: int, prefix: str, of: str, entries: int) -> DataFrame:
    """Counts and log perplexities; ``of`` is the hash of the text."""
    spark = docs.sparkSession
    once = distinct_texts(docs, text)
    scores, sizes = gram_scores(once, "text", order)
    cut = least_count(sizes, entries)
    common = table(scores.filter(F.col("n") >= cut).select("gram", "score"), entries)
    head = shared(spark, (common["gram"], common["score"]))
    new = [prefix + c for c in [*COUNTS, "log_perplexity", "base_failed", "kept"]]
    keep = [c for c in docs.columns if c not in new and c != text]
    body, size, part = (fresh(docs, c) for c in ("__text", "__bytes", "__sum"))

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        raw, off = flat(block.column(body))
        counts = measures(raw, off)
        distinct, which, rows = _row_grams(raw, off, order)
        total = np.bincount(rows, weights=_find(*head.value, distinct, 0.0)[which], minlength=len(off) - 1)
        columns = {c: block.column(c) for c in [*keep, of]}
        columns |= {prefix + c: pa.array(counts[c], pa.int64()) for c in COUNTS}
        columns |= {size: pa.array(np.diff(off), pa.int64()), part: pa.array(total, pa.float64())}
        return batch(**columns)

    whole = F.col(f"`{text}`").cast("string")
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.xxhash64(whole).alias(of), whole.alias(body))
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [f"`{of}` bigint"]
                       + [f"`{prefix}{c}` bigint" for c in COUNTS] + [f"`{size}` bigint, `{part}` double"])
    out = map_blocks(source, kernel, schema, body, COUNT_BYTES)
    total = F.col(part)
    if cut > 1:
        rest = materialize(_rest(once, scores, head, cut, order), "rest")
        more = fresh(out, "__rest")
        out = lookup_join(out, rest.toDF(of, more), [of])
        total = total + F.coalesce(F.col(more), F.lit(0.0))
    n, repeated = F.col(f"`{prefix}n_words`"), F.col(f"`{prefix}n_repeat_words`")
    mean = -total / F.greatest(F.col(size), F.lit(1))
    names = [*keep, of, *[prefix + c for c in COUNTS]]
    out = out.select(*[F.col(f"`{c}`") for c in names], mean.alias(prefix + "log_perplexity"))
    return out.withColumn(prefix + "base_failed", (n < min_words) | (repeated * 100 > n * 50))


def _judged(scored: DataFrame, fence: float, prefix: str, lang: str, of: str) -> DataFrame:
    scored = materialize(scored, "scored")
    passed = scored.filter(~F.col(f"`{prefix}base_failed`"))
    name = F.col(f"`{lang}`").cast("string") if lang in scored.columns else F.lit("")
    once = passed.groupBy(F.coalesce(name, F.lit("")).alias("lang"), F.col(f"`{of}`").alias("of")) \
        .agg(F.min(f"`{prefix}log_perplexity`").alias("log_perplexity"))
    band = bands(once, fence)
    key, low, high = (fresh(scored, c) for c in ("__lang", "__low", "__high"))
    band = materialize(band.toDF(key, low, high), "bands")
    met = lookup_join(scored.withColumn(key, F.coalesce(name, F.lit(""))), band, [key],
                      fits=fits_broadcast(band)[1])
    inside = F.col(f"`{prefix}log_perplexity`").between(F.col(low), F.col(high))
    return met.withColumn(prefix + "kept", ~F.col(f"`{prefix}base_failed`") & F.coalesce(inside, F.lit(False))) \
        .drop(key, low, high, of)
