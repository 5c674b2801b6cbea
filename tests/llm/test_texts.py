"""Operators 3, 4 and 10 against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import gam, perplexity, secrets

from .cases import WORD, no_docs, odd_docs, odd_rows, words

KINDS = [(re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6),
         (re.compile(r"AKIA[A-Z0-9]+"), 0, 20), (re.compile(r"[0-9a-f]+"), 0, 24)]


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, (p, g, least) in enumerate(KINDS) for m in p.finditer(text)
             if len(m[g]) >= least]
    return sorted(found)


def check_secrets(rows, got):
    for (text, r) in zip(rows, got):
        spans = base_spans(text or "")
        names = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == i for _, k, _ in spans) for i in range(3))
        assert r["base_sha256"] == hashlib.sha256(names.encode()).hexdigest()
        assert set(filter(None, names.split(","))) <= set(r["spans"].split(","))


def test_secrets(spark):
    random.seed(9)
    parts = ["password=", "PassWd : '", "token=abc", "api_key = \"abcdef12", "APIKEY:x", "ſecret=abcdefgh", "AKIA" + "A1" * 9, "AKIAB",
             "deadbeef" * 3, "0f" * 11, " ", "\n", "é", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "secret=======", "to", "ken=zzzzzzz"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 8))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    got = sorted(secrets.scan(docs).collect())
    check_secrets(texts, got)
    assert any("pem:" in r["spans"] for r in got) and any("github:" in r["spans"] for r in got)


def test_secrets_on_odd_rows(spark):
    rows = sorted(odd_rows(), key=str)
    got = sorted(secrets.scan(odd_docs(spark)).collect(), key=lambda r: str(r["doc_id"]))
    assert len(got) == len(rows) and all(r["spans"] == "" for r in got)
    assert secrets.scan(no_docs(spark)).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query(r"AKIA[A-Z0-9]+") == frozenset([frozenset([b"aki", b"kia"])])
    assert secrets.trigram_query(r"[0-9a-f]{24,}") == secrets.ANY
    for word in (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey"):
        grams = {word[i:i + 3] for i in range(len(word) - 2)}
        assert any(grams <= x for x in secrets.trigram_query(secrets.BASE[0].pattern))
    assert secrets.trigram_query(r"(abc|x)y*def") == frozenset([frozenset([b"abc", b"def"]), frozenset([b"def"])])


def base_counts(text):
    text = text or ""
    w, seen, again = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), again, len(inside)


def test_quality_on_odd_rows(spark):
    got = perplexity.quality(odd_docs(spark)).collect()
    assert len(got) == len(odd_rows())
    want = Counter((str(i), base_counts(t)) for i, t, *_ in odd_rows())
    assert Counter((str(r["doc_id"]), tuple(r[c] for c in perplexity.COUNTS)) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert perplexity.quality(no_docs(spark)).count() == 0


def test_quality_counts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(300).cache()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in perplexity.quality(docs).collect():
        assert tuple(r[c] for c in perplexity.COUNTS) == base_counts(texts[r["doc_id"]])


def kneser_ney(texts, order):
    """The model by dictionaries, as in the definition."""
    levels = {order: Counter(g for t in texts for b in [b"\n" * (order - 1) + t.encode()]
                             for g in (b[i:i + order] for i in range(len(b) - order + 1)))}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    d = {k: perplexity.discounts(*[sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]) for k, c in levels.items()}
    total, less = defaultdict(float), defaultdict(float)
    for k, c in levels.items():
        for g, n in c.items():
            total[k, g[:-1]] += n
            less[k, g[:-1]] += d[k][min(n, 3) - 1]

    def p(g):
        if not g:
            return 1 / 256
        k = len(g)
        low = p(g[1:])
        if (k, g[:-1]) not in total:
            return low
        n = levels[k].get(g, 0)
        return (max(n - d[k][min(n, 3) - 1], 0) if n else 0) / total[k, g[:-1]] + less[k, g[:-1]] / total[k, g[:-1]] * low
    return p


def test_model_equals_the_definition(spark):
    random.seed(4)
    texts = ["".join(random.choices("abcd e\né", weights=[9, 5, 3, 2, 6, 2, 1, 1], k=random.randint(0, 120))) for _ in range(60)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model, p = perplexity.train(docs, order=3), kneser_ney(texts, 3)
    probe = [g.encode()[:3] for g in ("abc", "aaa", "zzz", "e\na", "dcb", "\n\na", "qab")]
    got = model.log_probability(np.array([int.from_bytes(g, "big") for g in probe]))
    assert got == pytest.approx([math.log(p(g)) for g in probe])
    context = [b"ab" + bytes([c]) for c in range(256)]
    assert np.exp(model.log_probability(np.array([int.from_bytes(g, "big") for g in context]))).sum() == pytest.approx(1)


def test_bounded_model_still_sums_to_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(100)
    model = perplexity.train(docs, entries=300)
    assert all(len(level[0]) <= 300 for level in model.levels)
    for h in (b"the ", b"zzzz", b"and "):
        grams = np.array([int.from_bytes(h + bytes([c]), "big") for c in range(256)])
        assert np.exp(model.log_probability(grams)).sum() == pytest.approx(1)


def test_bands_reject_noise_and_keep_prose(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    random.seed(1)
    noise = ["".join(random.choices("qxzjkvwQXZ#%&0123456789 ", k=900)) for _ in range(5)]
    both = docs.unionByName(spark.createDataFrame([(-1 - i, "en", t) for i, t in enumerate(noise)], docs.schema))
    out = perplexity.quality(both)
    assert out.filter("doc_id < 0 and kept").count() == 0
    clean = spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").select("doc_id")
    judged = out.filter("not base_failed").join(clean, "doc_id").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert judged > 0.99


def test_bands_are_outer_fences_on_both_sides(spark):
    random.seed(6)
    rows = [("a", random.gauss(1.5, 0.02)) for _ in range(3001)] + [("b", 2.0), ("c", 1.0), ("c", 3.0)]
    got = {r["lang"]: (r["low"], r["high"]) for r in
           perplexity.bands(spark.createDataFrame(rows, "lang string, log_perplexity double")).collect()}
    q1, q3 = np.quantile([x for lang, x in rows if lang == "a"], [0.25, 0.75])
    assert got["a"] == pytest.approx((q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1)), abs=0.008)
    assert got["a"][0] > 1.5 - 6 * 0.02 and got["a"][1] < 1.5 + 6 * 0.02
    assert got["b"] == pytest.approx((1.997, 2.003)) and got["c"][0] < 1 and got["c"][1] > 3


def test_bands_reject_repetition_that_base_rules_pass(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    repeated = [(-a, "en", " ".join(f"page {n}" for n in range(a, a + 150))) for a in (100, 300, 500)]
    out = perplexity.quality(docs.unionByName(spark.createDataFrame(repeated, docs.schema))).filter("doc_id < 0").collect()
    assert len(out) == 3 and not any(r["base_failed"] or r["kept"] for r in out)


def test_copies_of_one_text_change_no_verdict(spark, sf):
    """One text that holds a third of all rows, and most of its language, moves neither model nor band."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    before = {r["doc_id"]: (r["kept"], r["log_perplexity"]) for r in perplexity.quality(docs).collect()}
    one = next(r for r in sorted(docs.filter("lang = 'de'").collect()) if before[r["doc_id"]][0])
    copies = spark.range(1, docs.count() // 2 + 1).select((-F.col("id")).alias("doc_id"), F.lit(one["lang"]).alias("lang"),
                                                         F.lit(one["text"]).alias("text"))
    after = perplexity.quality(docs.unionByName(copies)).collect()
    assert {r["kept"] for r in after if r["doc_id"] < 0} == {True}
    for r in after:
        kept, log_perplexity = before[r["doc_id"] if r["doc_id"] >= 0 else one["doc_id"]]
        assert r["kept"] == kept and r["log_perplexity"] == pytest.approx(log_perplexity)


def test_classifier(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = gam.score(docs, labels).cache()
    assert out.count() == docs.count() and out.filter("score < 0 or score > 1 or score is null").count() == 0
    tested = out.filter("held_out").join(labels, "doc_id")
    assert tested.count() > 30
    right = tested.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95
    assert out.filter((F.col("score") >= 0.3) != (F.col("predicted") == 1)).count() == 0


def test_classifier_learns_nothing_from_the_held_out_fold(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(gam.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {r["doc_id"]: r["score"] for r in gam.score(docs, labels).collect()}
    assert {r["doc_id"]: r["score"] for r in gam.score(docs, turned).collect()} == first


def test_classifier_on_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (4, None, 0), (5, 1, 0), (9, 0, 1), (10, 0, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = gam.score(odd_docs(spark), labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
    none = gam.score(odd_docs(spark), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert gam.score(no_docs(spark), labels).count() == 0


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x, y)
    assert {model.pairs[0][0], model.pairs[0][1]} == {0, 1}
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.95


def test_measures_need_no_words(spark):
    docs = spark.createDataFrame([(1, ""), (2, "\n\n"), (3, words(3))], "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_words"] for r in perplexity.quality(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 3}


def test_frequent_never_takes_more_than_fits(spark):
    from corvane.llm.rows import frequent
    random.seed(2)
    values = [random.choice([1, 2, 3, 9, 4466, 4467, 5000, 10 ** 6 + random.randint(0, 10 ** 5)]) for _ in range(500)]
    counts = spark.createDataFrame([(v,) for v in values], "n bigint")
    for entries in (0, 1, 60, 200, 499, 500):
        cut = frequent(counts, "n", entries)
        assert sum(v >= cut for v in values) <= entries
    assert frequent(counts, "n", 500) == 1 and frequent(counts.limit(0), "n", 5) == 1


def test_counting_blocks_stay_small():
    """Tasks that count hold few arrays of one block of a megabyte; four megabytes took 190 MB and more."""
    import tracemalloc

    import pyarrow as pa

    from corvane.llm import collocations, kernels, perplexity
    texts = pa.RecordBatch.from_pydict({"text": ["ab cd efg " * 3000] * 200, "lang": ["en"] * 200})
    for count in (lambda b: collocations.words(b), lambda b: perplexity._runs(np.sort(perplexity.grams(*kernels.flat(b.column("text")))[0]))):
        tracemalloc.start()
        for block in kernels.blocks(iter([texts]), max_bytes=kernels.COUNT_BYTES):
            count(block)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100 * 2 ** 20
    parts = [(np.array([1, 5]), np.array([2, 3])), (np.array([5, 7]), np.array([4, 1]))]
    assert [x.tolist() for x in perplexity._summed(parts)] == [[1, 5, 7], [2, 7, 1]]


def test_rare_ngrams_keep_their_scores(spark, sf):
    """a table of few n-grams gives the scores of the whole model, which are those of the definition."""
    random.seed(8)
    texts = ["".join(random.choices("abcd e\né", weights=[9, 5, 3, 2, 6, 2, 1, 1], k=random.randint(0, 120))) for _ in range(60)]
    rows = [(i, "en", t) for i, t in enumerate([*texts, *texts[:20], None])]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(3)
    p = kneser_ney(sorted(set(texts) | {""}), 3)
    for entries in (0, 7, 2 ** 20):
        got = {r["doc_id"]: r["log_perplexity"] for r in perplexity.quality(docs, order=3, entries=entries).collect()}
        assert len(got) == len(rows)
        for i, _, t in rows:
            b = b"\n\n" + (t or "").encode()
            want = -sum(math.log(p(b[j:j + 3])) for j in range(len(b) - 2)) / max(len(b) - 2, 1)
            assert got[i] == pytest.approx(want)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(300)
    few, whole = ({r["doc_id"]: (r["kept"], r["log_perplexity"]) for r in perplexity.quality(docs, entries=n).collect()} for n in (500, 2 ** 20))
    assert few.keys() == whole.keys() and all(few[i][0] == whole[i][0] and few[i][1] == pytest.approx(whole[i][1]) for i in few)
