"""ROUGE F-scores x 100 of prediction and reference columns."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile("[a-z0-9]+")


def rouge_n(pairs: DataFrame, n: int, key: Sequence[str], pred: str = "prediction",
            ref: str = "reference") -> DataFrame:
    """F-score of shared n-grams per pair, in column ``rouge<n>``; a missing text is empty and scores 0."""
    return rouge(pairs, key, [f"rouge{n}"], pred, ref)


def _shared_grams(n: int, ref: str, pred: str) -> float:
    """F-score of the n-grams that two texts share, each as often as in the one that has fewer."""
    r, p = (Counter(zip(*[tokens[i:] for i in range(n)])) for tokens in (_TOKEN.findall(ref), _TOKEN.findall(pred)))
    return _f_score((r & p).total(), r.total(), p.total())


def _places(tokens: Sequence[str]) -> dict[str, int]:
    """The positions of each token, as bits."""
    where: dict[str, int] = {}
    for i, token in enumerate(tokens):
        where[token] = where.get(token, 0) | (1 << i)
    return where


def _next_row(row: int, hits: int, full: int) -> int:
    """Row of the subsequence table after one more token; its low i bits hold i minus the length for i tokens."""
    hits &= row
    return ((row + hits) | (row - hits)) & full


def _lcs_length(a: Sequence[str], b: Sequence[str]) -> int:
    """Longest common subsequence length, bit-parallel over the tokens of ``a``."""
    where, full = _places(a), (1 << len(a)) - 1
    row = full
    for token in b:
        row = _next_row(row, where.get(token, 0), full)
    return len(a) - row.bit_count()


def _lcs_positions(ref: Sequence[str], cand: Sequence[str]) -> set[int]:
    """Positions of ``ref`` on one longest common subsequence with ``cand``, walked back from the ends.

    Rows of bits are kept only at every root of the candidate's length and made again
    stretch by stretch, so two lines of n words take about n ** 1.5 / 4 bytes besides the places of each word.
    """
    where, full = _places(ref), (1 << len(ref)) - 1
    every = max(1, math.isqrt(len(cand)))
    marks, row = [full], full
    for j, token in enumerate(cand, 1):
        row = _next_row(row, where.get(token, 0), full)
        if j % every == 0:
            marks.append(row)
    found: set[int] = set()
    i, j = len(ref), len(cand)
    base, rows = len(cand) + 1, []
    while i and j:
        if ref[i - 1] == cand[j - 1]:
            found.add(i - 1)
            i, j = i - 1, j - 1
            continue
        if j - 1 < base:
            base = (j - 1) // every * every
            rows = [marks[base // every]]
            for token in cand[base:j]:
                rows.append(_next_row(rows[-1], where.get(token, 0), full))
        if _common(rows[j - 1 - base], i) > _common(rows[j - base], i - 1):
            j -= 1
        else:
            i -= 1
    return found


def _common(row: int, i: int) -> int:
    return i - (row & ((1 << i) - 1)).bit_count()


def _f_score(hit: int, m: int, n: int) -> float:
    if not hit:
        return 0.0
    recall, precision = hit / m, hit / n
    return 100 * 2 * precision * recall / (precision + recall)


def _lsum(ref: str, pred: str) -> float:
    """Per reference line, the union of its common subsequences with all predicted lines."""
    refs = [tuple(_TOKEN.findall(line)) for line in ref.lower().split("\n")]
    cands = [tuple(_TOKEN.findall(line)) for line in pred.lower().split("\n")]
    m, n = sum(map(len, refs)), sum(map(len, cands))
    left_ref = Counter(w for line in refs for w in line)
    left_cand = Counter(w for line in cands for w in line)
    # Equal lines give equal positions, and lines without a common word give none.
    distinct = [(cand, set(cand)) for cand in dict.fromkeys(cands) if cand]
    unions: dict[tuple[str, ...], list[int]] = {}
    hit = 0
    for line in refs:
        if line not in unions:
            words = set(line)
            found = [_lcs_positions(line, cand) for cand, vocab in distinct if not words.isdisjoint(vocab)]
            unions[line] = sorted(set().union(*found))
        for pos in unions[line]:
            word = line[pos]
            if left_ref[word] > 0 and left_cand[word] > 0:
                left_ref[word] -= 1
                left_cand[word] -= 1
                hit += 1
    return _f_score(hit, m, n)


def _whole(ref: str, pred: str) -> float:
    a, b = _TOKEN.findall(ref.lower()), _TOKEN.findall(pred.lower())
    return _f_score(_lcs_length(a, b), len(a), len(b))


_VARIANTS = {"rougeL": _whole, "rougeLsum": _lsum}


def rouge(pairs: DataFrame, key: Sequence[str], scores: Sequence[str], pred: str = "prediction",
          ref: str = "reference") -> DataFrame:
    """Columns ``scores`` (``rouge1``, ``rouge2``, ..., ``rougeL``, ``rougeLsum``) per pair, from one pass over the pairs.

    Pairs are independent: they are scored in Arrow batches without a shuffle, and a task holds the
    n-grams of one pair at a time. A missing text is empty and scores 0.
    """
    fields = {f.name: f.dataType.simpleString() for f in pairs.schema}
    schema = ", ".join([f"`{k}` {fields[k]}" for k in key] + [f"{v} double" for v in scores])
    scorers = {v: _VARIANTS[v] if v in _VARIANTS else partial(_shared_grams, int(v.removeprefix("rouge"))) for v in scores}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[list(key)].copy()
            for v, scorer in scorers.items():
                out[v] = [scorer(r or "", p or "") for p, r in zip(pdf["__p"], pdf["__r"])]
            yield out

    return pairs.select(*key, F.lower(pred).alias("__p"), F.lower(ref).alias("__r")).mapInPandas(score, schema)


def rouge_l(pairs: DataFrame, key: Sequence[str], pred: str = "prediction", ref: str = "reference",
            variants: Sequence[str] = tuple(_VARIANTS)) -> DataFrame:
    """Longest-common-subsequence F-scores of whole texts (``rougeL``) and the per-line union (``rougeLsum``).

    Only the ``variants`` asked for are computed. A subsequence table has no relational form of its size.
    """
    return rouge(pairs, key, variants, pred, ref)
