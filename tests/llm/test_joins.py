"""Operators 1, 7 and 8 against brute force."""

import random
from collections import defaultdict
from itertools import combinations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvane.llm import decontaminate, jaccard_join, line_dedup, linking

from .cases import WORD, Union, levenshtein, no_docs, odd_docs, odd_rows, words


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def by_brute_force(rows):
    """{(doc_id, text): (n, least id)} for rows with unique ids."""
    sets, union = {i: shingle_set(t) for i, t in rows}, Union()
    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            union.join(a, b)
    return {i: (len(s), union.find(i)) for i, s in sets.items()}


def near_copies(seed, n_bases=12, n_copies=14):
    """Groups of copies with few and with many edits, and a passage that many texts share."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = random.choices(vocabulary, k=60)
    out = []
    for _ in range(n_bases):
        base = random.choices(vocabulary, k=random.randint(8, 220))
        if random.random() < 0.5:
            base = base[:100] + passage + base[100:]
        out.append(base)
        for _ in range(random.randint(0, n_copies)):
            copy = list(random.choice(out[-3:]))
            for _ in range(random.choice([0, 1, 2, 4, 9])):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            out.append(copy)
    out += [passage + random.choices(vocabulary, k=5) for _ in range(10)]
    random.shuffle(out)
    return [(i, random.choice([" ", "\n", "  "]).join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_join(spark, seed):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(docs).collect()}
    assert got == by_brute_force(rows)


@pytest.mark.parametrize("percent", [50, 90])
def test_jaccard_join_at_other_thresholds(spark, percent):
    rows = near_copies(4, 6)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets, union = {i: shingle_set(t) for i, t in rows}, Union()
    for a, b in combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            union.join(a, b)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.components(docs, percent=percent).collect()}
    assert got == {i: union.find(i) for i in sets}


def test_jaccard_join_beyond_tables_in_memory(spark, monkeypatch):
    rows = near_copies(5)
    monkeypatch.setattr(jaccard_join, "TABLE_ENTRIES", 1)
    monkeypatch.setattr(jaccard_join, "frequent", lambda counts, name: 10 ** 9)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(docs).collect()}
    assert got == by_brute_force(rows)


def test_jaccard_join_on_odd_rows(spark):
    got = jaccard_join.components(odd_docs(spark)).collect()
    assert len(got) == len(odd_rows())
    of = defaultdict(set)
    for r in got:
        of[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert of[1] == of[4] == of[5] == {(116, 1)}
    assert of[2] == {(0, 2)} and of[3] == {(0, 3)} and of[6] == {(0, 6)}
    assert of[9] == of[10] == {(1, 9)} and of[11] == {(1, 11)}
    assert of[None] == {(56, None)} and of[12] == {(0, 12)}
    assert jaccard_join.components(no_docs(spark)).count() == 0


def test_one_of_each_class_stays(spark):
    docs = odd_docs(spark, clashes=False)
    got = sorted(str(r["doc_id"]) for r in jaccard_join.keep_one(docs).collect())
    assert got == sorted(map(str, [1, 2, 3, None, 6, 7, 8, 9, 11, 12, 13, 14]))
    assert jaccard_join.keep_one(odd_docs(spark)).columns == odd_docs(spark).columns
    assert jaccard_join.keep_one(no_docs(spark)).count() == 0


def test_components(spark):
    random.seed(3)
    links = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    union = Union()
    for a, b in links:
        union.join(a, b)
    got = linking.components(spark.createDataFrame(links, "a bigint, b bigint"))
    rows = [(r["id"], r["label"]) for r in got.collect()]
    ends = {x for a, b in links if a != b for x in (a, b)}
    assert len(rows) == len(ends) and dict(rows) == {x: union.find(x) for x in ends}
    assert linking.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_banded_distance():
    random.seed(8)
    for _ in range(4000):
        a = bytes(random.choices(b"abc", k=random.randint(0, 9)))
        b = bytearray(a if random.random() < 0.7 else random.choices(b"abc", k=random.randint(0, 9)))
        for _ in range(random.randint(0, 4)):
            at = random.randint(0, len(b))
            b[at:at + random.randint(0, 1)] = random.choices(b"abc", k=random.randint(0, 1))
        for most in range(4):
            assert line_dedup.banded(a, bytes(b), most) == (levenshtein(a, b) <= most)


def edited_lines(seed):
    random.seed(seed)
    lines = []
    for _ in range(40):
        line = "".join(random.choices("abcdefg hié", k=random.randint(3, 70)))
        lines.append(line)
        for _ in range(random.randint(0, 5)):
            copy = list(random.choice(lines[-2:]))
            for _ in range(random.randint(0, 3)):
                at = random.randint(0, len(copy))
                copy[at:at + random.randint(0, 1)] = random.choices("abcxyz", k=random.randint(0, 1))
            lines.append("".join(copy))
    lines += ["x" * 30, "x" * 31, "x" * 32, "ab" * 20, "ab" * 21, "", "", " "]
    return [(i, "\n".join(random.choices(lines, k=random.randint(0, 6)))) for i in range(80)]


def deduped(rows, edits=2):
    places = defaultdict(list)
    for i, text in rows:
        for n, line in enumerate(text.split("\n")):
            if WORD.search(line):
                places[line.encode()].append((i, n))
    union = Union()
    for a, b in combinations(places, 2):
        union.find(a), union.find(b)
        if min(len(a), len(b)) >= 24 and abs(len(a) - len(b)) <= edits and levenshtein(a, b) <= edits:
            union.join(a, b)
    groups = defaultdict(list)
    for line, at in places.items():
        groups[union.find(line)] += at
    gone = {x for at in groups.values() for x in at if x != min(at)}
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup(spark, seed):
    rows = edited_lines(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = line_dedup.dedup(docs, counts=True).collect()
    assert {r["doc_id"]: r["text"] for r in got} == deduped(rows)
    assert all(r["n_lines"] - r["n_removed"] == r["text"].count("\n") + 1 for r in got if r["n_removed"] < r["n_lines"])


def test_line_dedup_beyond_tables_in_memory(spark):
    rows = edited_lines(3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    try:
        spark.conf.set("spark.corvane.broadcastBytes", "1")
        spark.conf.set("spark.corvane.rowsPerTask", "10")
        got = line_dedup.dedup(docs).collect()
    finally:
        spark.conf.unset("spark.corvane.broadcastBytes")
        spark.conf.unset("spark.corvane.rowsPerTask")
    assert {r["doc_id"]: r["text"] for r in got} == deduped(rows)


def test_line_dedup_on_odd_rows(spark):
    docs = odd_docs(spark)
    got = line_dedup.dedup(docs).collect()
    assert line_dedup.dedup(docs).columns == docs.columns and len(got) == len(odd_rows())
    text = {r["doc_id"]: r["text"] for r in got}
    assert text[1] == odd_rows()[0][1] and text[4] == "" and text[2] is None and text[3] == ""
    assert text[7] == odd_rows()[8][1].split("\n")[0] + "\n"
    assert text[14] == "line one is here for you\n\nend"
    assert line_dedup.dedup(no_docs(spark)).count() == 0


def distance_to_part(item, text):
    """Least edits of the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks(spark):
    random.seed(2)
    items = [" ".join(random.choices(["ab", "cde", "fgh", "Ü", "xyz", "q"], k=k)) for k in (9, 15, 30, 60, 8, 25)]
    texts = []
    for n in range(60):
        item = list(random.choice(items))
        for _ in range(random.randint(0, 6)):
            at = random.randint(0, len(item))
            item[at:at + random.randint(0, 1)] = random.choices("abz ", k=random.randint(0, 1))
        lead = " ".join(random.choices(["ab", "cde", "fgh", "tail"], k=random.randint(0, 20)))
        texts.append(lead + random.choice(["", " ", "\n"]) + "".join(item).upper() + random.choice(["", "  .", lead]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    want = {}
    for i, t in enumerate(texts):
        for k, item in enumerate(items):
            pattern = decontaminate.normal_bytes(item)
            raw, off = decontaminate.normal(*decontaminate.flat(pa.array([t])))
            edits = distance_to_part(pattern, raw.tobytes())
            if len(pattern) >= 20 and edits <= int(len(pattern) * 0.05):
                want[i, k] = edits
    got = decontaminate.leaks(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in got} == want and want
    left = {r["doc_id"] for r in decontaminate.clean(docs, benchmark).collect()}
    assert left == set(range(len(texts))) - {i for i, _ in want}


def test_leaks_in_passes(spark, sf, monkeypatch):
    docs, benchmark = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(decontaminate.leaks(docs, benchmark).collect())
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 3000)
    assert len(list(decontaminate.matchers(benchmark))) > 2
    assert sorted(decontaminate.leaks(docs, benchmark).collect()) == want
    verbatim = docs.crossJoin(benchmark.select("item_id", F.col("text").alias("item"))).filter("contains(text, item)")
    assert {(r["doc_id"], r["item_id"]) for r in verbatim.collect()} <= {(r["doc_id"], r["item_id"]) for r in want}


def test_leaks_on_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, words(30, 10, "rund"), 5), (2, None, 5), (3, "", 5), (4, "short", 5), (None, words(30, 10, "rund"), 5),
                                       (5, "x" * 40, 5)], "item_id bigint, text string, doc_id int")
    docs = odd_docs(spark)
    got = decontaminate.leaks(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in got if r["item_id"] is not None) == [
        (1, 1, 0), (4, 1, 0), (5, 1, 0), (5, 1, 0), (13, 5, 0)]
    assert sorted(r["doc_id"] for r in got if r["item_id"] is None) == [1, 4, 5, 5]  # the item without an id
    left = decontaminate.clean(docs, benchmark)
    assert left.columns == docs.columns and left.count() == len(odd_rows()) - 5
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.clean(no_docs(spark), benchmark).count() == 0


def test_short_items_and_items_without_an_id(spark):
    benchmark = spark.createDataFrame([(1, "the Blue  whale"), (2, "42"), (None, words(20, 3, "frei")), (3, " \t"), (None, None)],
                                      "item_id bigint, text string")
    texts = ["see the blue whale, now", "the blue whales swim", "bathe blue whale", "page 42.", "1421", "x42", "42",
             "the blue whole", words(40, 0, "frei"), " ", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"], r["edits"], r["end_byte"]) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert {g[:3] for g in got} == {(0, 1, 0), (3, 2, 0), (6, 2, 0), (8, None, 0)}
    assert (0, 1, 0, 18) in got and (3, 2, 0, 7) in got
    assert {r["doc_id"] for r in decontaminate.clean(docs, benchmark).collect()} == {1, 2, 4, 5, 7, 9, 10}


def test_short_pieces_are_found():
    matcher = decontaminate.Matcher([(1, b"abcdefghij klmnop qrs")], rate=0.2)
    raw, off = decontaminate.flat(pa.array(["xx abcdefgh1j kl2nop 3rs yy", "abc"]))
    assert [(r, i, e) for r, i, e, _ in matcher.find(raw, off)] == [(0, 1, 3)]


def made_in_the_second_round(monkeypatch):
    """Rows that the second round's join on keys makes, by call."""
    made, residual = [], linking.residual

    def counted(*args):
        out = residual(*args)
        made.append(out.agg(F.sum("shared")).first()[0] or 0)
        return out
    monkeypatch.setattr(linking, "residual", counted)
    return made


def family(size, seed=11):
    """Copies of one text with so many words replaced that about half of them are not linked with the others."""
    random.seed(seed)
    base, out = [f"w{i}" for i in range(400)], []
    for i in range(size):
        copy = list(base)
        for _ in range(random.randint(0, 15)):
            copy[random.randrange(len(copy))] = f"x{random.randrange(10 ** 6)}"
        out.append((i, " ".join(copy)))
    return out


def test_outsiders_of_a_large_family(spark, monkeypatch):
    made, rows = made_in_the_second_round(monkeypatch), family(180)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(docs).collect()}
    want = by_brute_force(rows)
    assert got == want and 20 < len({c for _, c in want.values()}) < 160
    assert sum(made) < 20 * len(rows)


@pytest.mark.parametrize("percent", [50, 75])
def test_jaccard_join_through_centers(spark, monkeypatch, percent):
    monkeypatch.setattr(linking, "LARGE", 1)
    monkeypatch.setattr(linking, "OUTSIDERS", 3)
    rows = near_copies(6, 8)
    rows += [(len(rows) + i, t) for i, t in family(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    sets, union = {i: shingle_set(t) for i, t in rows}, Union()
    for a, b in combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            union.join(a, b)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.components(docs, percent=percent).collect()}
    assert got == {i: union.find(i) for i in sets}


def test_lines_of_the_same_letters(spark, monkeypatch):
    """Lines that share a segment and all their letters, in another order, are told apart before they are paired."""
    random.seed(5)
    made, tail = made_in_the_second_round(monkeypatch), "abcdefghijklmnopqrstuvwxyz012345"
    rows = [(i, "the same start of every line " * 8 + "".join(random.sample(tail, len(tail)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, line_dedup.dedup(docs).collect())) == rows
    assert sum(made) < len(rows)
