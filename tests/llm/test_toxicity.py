"""Operator 12: kernel against a plain double sum, held-out accuracy, gapped words, awkward rows."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import toxicity

from .cases import no_docs, odd_docs, odd_rows


def _subsequences(word):
    """Weight of every subsequence of three and four characters of a word with its ends, at most two skipped."""
    chars, out = f"\x01{word}\x02", defaultdict(float)
    for size in (3, 4):
        for at in combinations(range(len(chars)), size):
            skipped = at[-1] - at[0] + 1 - size
            if skipped <= 2:
                out["".join(chars[i] for i in at)] += 0.5 ** skipped
    return out


def _norm(word):
    chars = len(word) + 2
    return sum(0.25 ** (at[-1] - at[0] + 1 - size) for size in (3, 4) for at in combinations(range(chars), size)
               if at[-1] - at[0] + 1 - size <= 2) ** 0.5


def _kernel(a, b):
    x, y = _subsequences(a), _subsequences(b)
    return sum(v * y[k] for k, v in x.items() if k in y) / (_norm(a) * _norm(b))


def test_kernel_equals_a_plain_sum():
    random.seed(3)
    chosen = ["".join(random.choices("abcé", k=k)) for k in (1, 2, 3, 5, 8, 13)]
    others = ["".join(random.choices("abcé", k=random.randint(1, 12))) for _ in range(40)]
    got = toxicity.Landmarks(chosen).kernel(toxicity.examples(others), step=7)
    want = [[_kernel(a, b) for b in chosen] for a in others]
    assert np.allclose(got, want)


def test_margin_equals_the_machine_on_nystrom_features():
    random.seed(4)
    make = lambda n: {"".join(random.choices("abcdefgh", k=random.randint(3, 9))): 1.0 for _ in range(n)}
    positive, negative = make(30), make(60)
    model = toxicity.fit(positive, negative)
    pos, neg = sorted(positive), sorted(w for w in negative if w not in positive)
    marks = toxicity.Landmarks(pos + neg)
    y = np.append(np.ones(len(pos)), -np.ones(len(neg)))
    weight = np.where(y == 1, 1 / len(pos), 1 / len(neg))
    v, bias = toxicity._machine(marks.features(toxicity.examples(pos + neg)), y, weight)
    new = toxicity.examples(list(make(20)))
    assert np.allclose(model.word_margins(new), marks.features(new) @ v + bias)
    assert (np.sign(model.word_margins(toxicity.examples(pos + neg))) == y).mean() > 0.95


@pytest.mark.parametrize("text,want", [
    ("You ID-iot! st*pid", ["you", "idiot", "stpid"]), ("i d i o t", ["idiot"]), ("an i.d.i.o.t is", ["an", "idiot", "is"]),
    ("a b", ["a", "b"]), ("trash### x|y", ["trash", "x", "y"]), ("", []), (" \n ", []), ("### !!", []), ("Über 中文 12", ["über", "中文", "12"])])
def test_words(text, want):
    got = toxicity.words(["q", text, ""])
    mine = [got.written(i) for i in np.flatnonzero(got.owner == 1)]
    assert mine == want and (got.owner != 2).all()


def _scores(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert len(rows) == labels.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    return [r for r in rows if r["held_out"]]


def test_held_out_accuracy(spark):
    rows = _scores(spark, "/root/testdata/sf0.1")
    toxic, clean = ([r for r in rows if r["toxic"] == y] for y in (1, 0))
    assert sum(r["predicted"] for r in toxic) / len(toxic) > 0.85
    assert sum(r["predicted"] for r in clean) / len(clean) < 0.02


def test_gapped_and_inserted_words(spark):
    """The machine knows the plain words only; split, padded and marked spellings are found all the same."""
    random.seed(8)
    insults = ["worthless", "pathetic", "disgusting", "loathsome"]
    plain = ["".join(random.choices("aeioulnrst", k=random.randint(2, 9))) for _ in range(400)]
    rows = [(i, " ".join(random.choices(plain, k=30) + ([random.choice(insults)] if i % 3 == 0 else []))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    tests = ["worth less" if w == "none" else s for w in insults for s in
             (w, w.upper() + "!", ".".join(w), " ".join(w), w[:3] + "x" + w[3:], w[:4] + "*" + w[4:], w + "###")]
    new = [(10 ** 6 + i, " ".join(random.choices(plain, k=30)) + " " + t) for i, t in enumerate(tests)]
    clean = [(2 * 10 ** 6 + i, " ".join(random.choices(plain, k=30))) for i in range(200)]
    every = docs.unionByName(spark.createDataFrame(new + clean, docs.schema))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(every, labels).filter("doc_id >= 1000000").collect()}
    assert sum(got[i] for i, _ in new) >= 0.9 * len(new)
    assert sum(got[i] for i, _ in clean) <= 4


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumn("worst", F.lit(1))
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(0, 15)] + [(None, 1, 1), (2, None, 1), (3, 0, 1), (3, 1, 0)],
                                   "doc_id bigint, toxic int, quality int")
    for known in (labels, labels.limit(0), labels.filter("toxic = 1")):
        got = toxicity.score(docs, known).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in odd_rows())
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] is not None for r in got)
    assert toxicity.score(no_docs(spark), labels).count() == 0
    long = spark.createDataFrame([(1, "wort " * 600_000)], "doc_id bigint, text string")
    assert toxicity.score(long, labels.limit(0)).count() == 1
