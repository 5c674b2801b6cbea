"""Operators 2 and 6, and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corvane.llm import codec, decontaminate, jaccard_join, line_dedup, perplexity, sharding, snapshots

from .cases import WORD, no_docs, odd_docs, odd_rows


def test_differencing_beats_greedy():
    random.seed(7)
    sizes = [random.randint(1, 10 ** 6) for _ in range(3000)]
    where = sharding.differencing(sizes, 16)
    assert sorted(set(where)) == list(range(16)) and sharding.spread(sizes, where, 16) <= 16
    sums, greedy = [0] * 16, []
    for s in sorted(sizes, reverse=True):
        greedy.append(sums.index(min(sums)))
        sums[greedy[-1]] += s
    assert sharding.spread(sizes, where, 16) <= max(sums) - min(sums)
    assert sharding.differencing([], 4) == [] and sharding.differencing([5], 1) == [0]
    assert sorted(sharding.differencing([9, 9, 9], 3)) == [0, 1, 2]


def check_shards(rows, got, shards=16):
    assert Counter((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == Counter(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    of, slots = defaultdict(set), defaultdict(list)
    for r in got:
        of[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(len(s) == 1 for s in of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sharding.shard_by_bytes(docs).collect()
    check_shards([(r["doc_id"], r["text"]) for r in docs.collect()], got)
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) - min(sums.values()) <= 64


def test_shards_of_parcels_and_one_large_group(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    hot = docs.filter("doc_id = 0").crossJoin(spark.range(600)).select((F.col("id") + 10 ** 6).alias("doc_id"), "text")
    got = sharding.shard_by_bytes(docs.unionByName(hot), parcels=256).collect()
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["size"]
    own = sums.most_common()
    assert own[0][1] > 2 * own[1][1]  # a group is never cut
    assert own[1][1] - own[-1][1] < 0.02 * own[1][1]


def test_shards_of_odd_rows(spark):
    rows = [(i, t) for i, t, *_ in odd_rows()]
    check_shards(rows, sharding.shard_by_bytes(odd_docs(spark)).collect())
    assert sharding.shard_by_bytes(no_docs(spark)).count() == 0


def test_shards_keep_columns_of_any_name(spark):
    names = ["own", "lot", "first", "part", "at", "n", "bytes", "__parcel", "__group", "__row", "__own", "__lot", "__first", "__at"]
    docs = odd_docs(spark, clashes=False).withColumns({c: F.lit(7) for c in names})
    got = sharding.shard_by_bytes(docs).collect()
    check_shards([(i, t) for i, t, *_ in odd_rows()], got)
    assert all(r[c] == 7 for r in got for c in names)


def snapshots_by_brute_force(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: tuple((r, x) for *_, r, x in sorted(t)) for c, t in talks.items()}
    out = {}
    for c, talk in talks.items():
        equal = [d for d, other in talks.items() if other == talk]
        longer = any(len(o) > len(talk) and o[:len(talk)] == talk for o in talks.values())
        first = min((d for d in equal if d is not None), default=None)
        if not longer and c == first:
            out[c] = ("".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in talk), len(talk), len(equal))
    return out


def collapsed(df):
    talks = defaultdict(list)
    for r in df.collect():
        talks[r["conv_id"]].append(r)
    out = {}
    for c, turns in talks.items():
        turns.sort(key=lambda r: r["turn_ix"])
        text = ""
        for i, r in enumerate(turns):
            assert r["turn_ix"] == i and r["at"] == len(text)
            text += r["rendered"]
        assert {r["n_turns"] for r in turns} == {len(turns)}
        out[c] = (text, len(turns), turns[0]["n_copies"])
    return out


@pytest.mark.parametrize("rows_per_task", ["1000000", "7"])
def test_snapshots(spark, rows_per_task):
    random.seed(3)
    rows, talks = [], []
    for conv in range(120):
        if talks and random.random() < 0.6:
            talk = list(random.choice(talks))[:random.randint(1, 6)] + [random.choice("uv") for _ in range(random.randint(0, 2))]
        else:
            talk = [random.choice("abc") for _ in range(random.randint(1, 6))]
        talks.append(talk)
        rows += [(conv if conv != 50 else None, i * 2, random.choice(["user", None]) if i == 99 else "user", x) for i, x in enumerate(talk)]
    rows += [(500, i, "user", f"t{i}") for i in range(60)] + [(501, i, "user", f"t{i}") for i in range(59)]
    rows += [(502, None, None, None), (503, None, "", ""), (504, 1, "user", "same"), (504, 1, "user", "same"), (505, 1, "user", "same")]
    random.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string") \
        .withColumns({c: F.lit(3) for c in ("turn_ix", "kept", "h0", "at", "n_turns")})
    spark.conf.set("spark.corvane.rowsPerTask", rows_per_task)
    try:
        assert collapsed(snapshots.maximal(turns)) == snapshots_by_brute_force(rows)
        assert snapshots.maximal(turns.limit(0)).count() == 0
    finally:
        spark.conf.unset("spark.corvane.rowsPerTask")


def test_snapshots_run_no_python(spark, sf):
    plan = snapshots.maximal(spark.read.parquet(f"{sf}/conversations.parquet"))
    assert not any(w in plan._jdf.queryExecution().toString() for w in ("Python", "Pandas", "Arrow"))


def test_pipeline_stage_by_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in perplexity.quality(docs).filter("kept").collect()}
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf).cache()
        results[name] = docs
        if name != "bpe_codec":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert docs.schema.simpleString() == before.schema.simpleString()
    ids = {name: {r["doc_id"] for r in df.select("doc_id").collect()} for name, df in results.items()}
    assert ids["quality_rules"] == kept
    lines = results["line_dedup"]
    had = {r["doc_id"]: r["text"] or "" for r in results["quality_rules"].collect()}
    has = {r["doc_id"]: r["text"] or "" for r in line_dedup.dedup(results["quality_rules"]).collect()}
    assert ids["line_dedup"] == {i for i in had if WORD.search(has[i]) or not WORD.search(had[i])}
    assert all(WORD.search(r["text"] or "") or not WORD.search(had[r["doc_id"]]) for r in lines.collect())
    assert lines.filter(F.length("text") != F.col("n_chars")).count() == 0
    classes = jaccard_join.components(lines).filter("n_shingles > 0")
    alone = {r["doc_id"] for r in jaccard_join.components(lines).filter("n_shingles = 0").collect()}
    assert ids["ngram_jaccard"] == {r["component_id"] for r in classes.collect()} | alone
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    leaked = {r["doc_id"] for r in decontaminate.leaks(results["ngram_jaccard"], benchmark).collect()}
    assert ids["decontamination"] == ids["ngram_jaccard"] - leaked
    final = corpus_pipeline.run(spark, sf)
    assert sorted(final.collect()) == sorted(results["bpe_codec"].collect())


def test_pipeline_on_odd_rows(spark, sf):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        docs.count()
    empty = no_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
    assert empty.count() == 0


def test_operators_agree_with_the_helpers_they_share(spark):
    """A text that every operator sees gives one row in each."""
    docs = spark.createDataFrame([(1, "one two three four five six")], "doc_id bigint, text string")
    assert jaccard_join.components(docs).first()["n_shingles"] == 2
    assert line_dedup.dedup(docs).first()["text"] == "one two three four five six"
    assert codec.encode(docs, corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken")).count() == 1
