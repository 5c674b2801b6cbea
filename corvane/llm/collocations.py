"""Operator 13: phrase collocations by top-order marginalisation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.filters import KeyFilter, key_filter
from corvane.llm.kernels import BYTE_VALUES, COUNT_BYTES, FOLDED_VALUES, blocks, flat, longs, mix, span_hashes
from corvane.llm.rows import batch, map_blocks, materialize, shared
from corvane.scale import fits_broadcast, lookup_join
from corvane.ship import ship

#: Words of the longest phrase, least count of a candidate, phrases kept per language.
ORDER, LEAST, TOP = 4, 30, 2000
#: A candidate goes if a longer one that holds it has at least this percentage of its count.
COVERED = 80
SCALE = 2_000_000
#: Words whose text a task has sent; a full memory is emptied, which costs a second sending only.
_MEMORY = 2 ** 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_W = [f"w{i}" for i in range(1, ORDER + 1)]

_BLANK, _CUT = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_CUT[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_OUTSIDE = _BLANK | _CUT


def words(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(id, row, start, end, follows) of every word of a block's texts.

    The id is a 64-bit hash of language and folded word, never 0. ``follows`` tells whether the
    next word stands in the same piece.
    """
    raw, off = flat(block.column("text"))
    none = np.zeros(0, np.int64)
    if not len(raw):
        return none.astype(np.uint64), none, none, none, none.astype(bool)
    inside = ~_OUTSIDE[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    rows = np.searchsorted(off, starts, side="right") - 1
    lang_raw, lang_off = flat(block.column("lang"))
    langs = span_hashes(BYTE_VALUES[lang_raw], lang_off[:-1], lang_off[1:])
    ids = mix(span_hashes(FOLDED_VALUES[raw], starts, ends) * _ODD + langs[rows])
    ids[ids == 0] = 1
    cuts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_CUT[raw], out=cuts[1:])
    piece = cuts[starts]
    follows = np.zeros(len(starts), bool)
    follows[:-1] = (rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1])
    return ids, rows, starts, ends, follows


def _pairs(ids: np.ndarray) -> np.ndarray:
    """Hash of each word with the next one; the last has no next and stands for itself."""
    following = np.append(ids[1:], np.uint64(0))
    return mix(ids * _ODD + following)


def word_counts(source: DataFrame) -> DataFrame:
    """``word`` (id), ``n`` (occurrences), ``lang``, ``text`` of every distinct word of each language."""
    ship(source.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for block in blocks(batches, max_bytes=COUNT_BYTES):
            ids, rows, starts, ends, _ = words(block)
            keys, first, n = np.unique(ids, return_index=True, return_counts=True)
            known = [k in sent for k in keys.tolist()]
            if len(sent) > _MEMORY:
                sent.clear()
            sent.update(keys.tolist())
            raw, _ = flat(block.column("text"))
            data = raw.tobytes()
            spans = zip(starts[first].tolist(), ends[first].tolist(), known)
            text = [None if seen else data[a:b].lower().decode() for a, b, seen in spans]  # bytes.lower folds A-Z alone
            names = block.column("lang").to_pylist()
            lang = [None if seen else names[r] for r, seen in zip(rows[first].tolist(), known)]
            yield batch(word=longs(keys), n=pa.array(n, pa.int64()), lang=pa.array(lang, pa.string()),
                        text=pa.array(text, pa.string()))

    found = source.mapInArrow(count, "word bigint, n bigint, lang string, text string")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.max("lang").alias("lang"), F.max("text").alias("text"))


def pair_counts(source: DataFrame, frequent: KeyFilter) -> DataFrame:
    """``pair`` (hash), ``n``: neighbours inside a piece that both pass the filter of frequent words."""
    table = shared(source.sparkSession, frequent)

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        ids, *_, follows = words(block)
        passes = table.value(ids)
        follows[:-1] &= passes[:-1] & passes[1:]
        keys, n = np.unique(_pairs(ids)[follows], return_counts=True)
        return batch(pair=longs(keys), n=pa.array(n, pa.int64()))

    return map_blocks(source, kernel, "pair bigint, n bigint", max_bytes=COUNT_BYTES).groupBy("pair").agg(F.sum("n").alias("n"))


def windows(source: DataFrame, frequent: KeyFilter, pairs: KeyFilter) -> DataFrame:
    """``w1`` to ``w4``, ``n``: the longest window that starts at each word, padded with 0, counted per block.

    A window ends with its piece, before a word that is too rare for any candidate, and at a pair
    that is too rare for one. Windows of one word say nothing beyond the word counts and stay out.
    """
    words_table, pairs_table = shared(source.sparkSession, frequent), shared(source.sparkSession, pairs)

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        ids, *_, follows = words(block)
        passes = words_table.value(ids)
        follows[:-1] &= passes[:-1] & passes[1:]
        at = np.flatnonzero(follows)
        follows[at] = pairs_table.value(_pairs(ids)[at])
        at = np.flatnonzero(follows)
        lead, inside = [ids[at]], np.ones(len(at), bool)
        padded, linked = np.append(ids, np.zeros(ORDER, np.uint64)), np.append(follows, np.zeros(ORDER, bool))
        for k in range(1, ORDER):
            inside = inside & linked[at + k - 1]
            lead.append(np.where(inside, padded[at + k], np.uint64(0)))
        whole = np.zeros(len(at), np.uint64)
        for column in lead:
            whole = mix(whole * _ODD + column)
        _, first, n = np.unique(whole, return_index=True, return_counts=True)
        return batch(**{name: longs(column[first]) for name, column in zip(_W, lead)}, n=pa.array(n, pa.int64()))

    return map_blocks(source, kernel, ", ".join(f"{w} bigint" for w in _W) + ", n bigint", max_bytes=COUNT_BYTES)


def phrase_counts(found: DataFrame, least: int) -> DataFrame:
    """``w1`` to ``w4`` (0 after the end), ``size``, ``a``: phrases of two words and more with their exact counts.

    ROLLUP over the window columns sums every shorter prefix from the longest windows: the count of a
    phrase is that of all windows that start with it. A prefix that ends in padding is no phrase.
    """
    sums = found.rollup(*_W).agg(F.sum("n").alias("a"), F.grouping_id().alias("g"))
    size = F.lit(ORDER) - F.bit_count("g")
    last = reduce(lambda rest, i: F.when(F.col("size") == i, F.col(_W[i - 1])).otherwise(rest), range(2, ORDER + 1), F.lit(0))
    kept = sums.filter(F.col("a") >= least).withColumn("size", size.cast("int")).filter("size >= 2").filter(last != 0)
    return kept.select(*[F.coalesce(w, F.lit(0)).cast("bigint").alias(w) for w in _W], "size", "a")


def _parts(start: Column, size: Column) -> list[Column]:
    """The words ``start`` (from 0) to ``start + size`` of a phrase, padded with 0."""
    every = F.array(*_W)
    return [F.when(F.lit(i) < size, F.get(every, start + i)).otherwise(F.lit(0)).cast("bigint") for i in range(ORDER)]


def _split_scores(phrases: DataFrame, counts: DataFrame, fits: bool) -> DataFrame:
    """Adds ``l``, ``r``, ``score`` of each phrase's lowest-scoring cut."""
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    for side, start, size in (("l", F.lit(0), F.col("k")), ("r", F.col("k"), F.col("size") - F.col("k"))):
        names = [f"{side}{i}" for i in range(ORDER)]
        cuts = cuts.withColumns(dict(zip(names, _parts(start, size))))
        dims = counts.select(*[F.col(w).alias(n) for w, n in zip(_W, names)], F.col("a").alias(side))
        cuts = lookup_join(cuts, dims, names, "inner", fits=fits).drop(*names)
    # The product may pass 64 bits, so it is made in decimals.
    score = F.expr(f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(19, 0)) div CAST(l + r AS DECIMAL(20, 0))")
    least = cuts.groupBy(*_W, "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return least.select(*_W, "size", "a", "cut.l", "cut.r", "cut.score")


def _covered(phrases: DataFrame, covered: int) -> DataFrame:
    """Phrases that lie inside a longer candidate with at least ``covered`` per cent of their count."""
    longer = phrases.filter("size > 2")
    inner = F.expr("filter(flatten(transform(sequence(0, size - 2), s -> transform(sequence(2, size - s), "
                   "n -> struct(s, n)))), x -> x.n < size)")
    each = longer.withColumn("x", F.explode(inner)).withColumns(dict(zip([f"p{i}" for i in range(ORDER)],
                                                                         _parts(F.col("x.s"), F.col("x.n")))))
    top = each.groupBy(*[F.col(f"p{i}").alias(w) for i, w in enumerate(_W)]).agg(F.max("a").alias("most"))
    return phrases.join(top, _W).filter(F.col("most") * 100 >= F.col("a") * covered).select(*_W)


def collocations(docs: DataFrame, least: int = LEAST, top: int | None = TOP, covered: int = COVERED,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """Phrases of 2 to 4 words that stand together more often than their parts, per language.

    Only the longest windows are counted, one per word, padded where their piece ends; one ROLLUP over
    their four columns gives the counts of all shorter phrases. Before that, windows are ended at words
    and pairs below ``least``, which no candidate can hold: bit tables made from the counts of words and
    of hashed pairs pass every frequent one, so no count of a candidate changes.

    Returns ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``; the first ``top`` of each language
    (all with None) by score and count descending, then phrase. Null text: no words. Null language: ``und``,
    together with documents that say so. Very long texts: whole, a block of their own. Repeated rows: counted
    each time. No other column is read. Empty table, or no phrase of ``least``: empty result. Words are told
    apart by 64-bit hashes of language and word.
    """
    source = docs.select(F.col(f"`{text}`").cast("string").alias("text"),
                         F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"))
    counted = materialize(word_counts(source), "words")
    common = counted.filter(F.col("n") >= least)
    frequent = key_filter(common, "word")
    pairs = materialize(pair_counts(source, frequent).filter(F.col("n") >= least).select("pair"), "pairs")
    phrases = materialize(phrase_counts(windows(source, frequent, key_filter(pairs, "pair")), least), "phrases")
    single = common.select(F.col("word").alias("w1"), *[F.lit(0).cast("bigint").alias(w) for w in _W[1:]], F.col("n").alias("a"))
    counts = phrases.select(*_W, "a").unionByName(single)
    scored = _split_scores(phrases, counts, fits_broadcast(counts)[1])
    scored = scored.join(_covered(phrases, covered), _W, "left_anti")
    few = fits_broadcast(common)[1]
    totals = counted.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("n"))
    named = lookup_join(scored, common.select(F.col("word").alias("w1"), "lang"), ["w1"], "inner", fits=few)
    if top is not None:  # ties at the end of the list wait for the phrase's text
        leading = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
        named = named.withColumn("place", F.rank().over(leading)).filter(F.col("place") <= top).drop("place")
    for i, w in enumerate(_W):
        named = lookup_join(named, common.select(F.col("word").alias(w), F.col("text").alias(f"t{i}")), [w], "left", fits=few)
    phrase = F.concat_ws(" ", *[f"t{i}" for i in range(ORDER)])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = named.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(order).cast("bigint"))
    if top is not None:
        out = out.filter(F.col("rank") <= top)
    out = out.join(totals, F.col("lang") == F.col("of"))
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
