"""Operator 13 against a plain count of all phrases."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import collocations, filters

from .cases import no_docs, odd_docs


def _plain(rows, least, covered=80, top=None):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f.update((lang, *words[i:i + size]) for i in range(len(words) - size + 1))
    candidates = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    gone = {(k[0], *k[i:j]) for k, a in candidates.items() for i in range(1, len(k)) for j in range(i + 2, len(k) + 1)
            if j - i < len(k) - 1 and 100 * a >= covered * candidates[(k[0], *k[i:j])]}
    out = []
    for k, a in candidates.items():
        if k not in gone:
            cuts = [(f[k[:c + 1]], f[(k[0], *k[c + 1:])], c) for c in range(1, len(k) - 1)]
            score, _, l, r = min((2_000_000 * a // (l + r), c, l, r) for l, r, c in cuts)
            out.append((k[0], -score, -a, " ".join(k[1:]).encode(), l, r))
    ranks, final = Counter(), []
    for lang, score, a, phrase, l, r in sorted(out):
        ranks[lang] += 1
        if top is None or ranks[lang] <= top:
            final.append((lang, ranks[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(final)


def _check(docs, **how):
    got = collocations.collocations(docs, **how)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = _plain([(r["lang"], r["text"]) for r in docs.collect()], how.get("least", 30), top=how.get("top", 2000))
    assert sorted(map(tuple, got.collect())) == want
    return want


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(_check(docs)) > 100


@pytest.mark.parametrize("top", [7, None])
def test_low_limits(spark, top):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert _check(docs, least=3, top=top)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    more = [(90, "A b. a B! a b; ; a  b\t a b", "und"), (91, "a b a b a b a b", None), (92, "x y z w v x y z w v", "fr"),
            (93, "ÄB äb Äb äb Äb äb", "de"), (94, "é " * 5000, "fr"), (95, "", ""), (96, "q r. q r. q r", "")]
    docs = docs.select("doc_id", "text", "lang", "n", "size", "a").unionByName(
        spark.createDataFrame(more, "doc_id bigint, text string, lang string"), allowMissingColumns=True)
    assert _check(docs, least=2)
    assert collocations.collocations(no_docs(spark)).count() == 0
    assert collocations.collocations(odd_docs(spark), least=10 ** 6).count() == 0


def test_score_beyond_64_bits(spark):
    row = (1, 2, 0, 0, 2, 9 * 10 ** 12)
    names = "w1 bigint, w2 bigint, w3 bigint, w4 bigint, size int, a bigint"
    phrases = spark.createDataFrame([row], names)
    counts = spark.createDataFrame([(1, 0, 0, 0, 10 ** 13), (2, 0, 0, 0, 2 * 10 ** 13 + 1)], names.replace("size int, ", ""))
    got = collocations._split_scores(phrases, counts, True).first()
    assert got["score"] == 2_000_000 * 9 * 10 ** 12 // (3 * 10 ** 13 + 1)


def test_filter_passes_every_key(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("k"))
    held = np.array([r["k"] for r in keys.collect()], np.int64).view(np.uint64)
    table = filters.key_filter(keys, "k")
    assert table(held).all() and table(np.arange(10 ** 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).mean() < 0.05
    assert filters.key_filter(keys, "k", most_bits=1024)(held).all()
    assert not filters.key_filter(keys.limit(0), "k")(held).any()
