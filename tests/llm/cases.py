"""Awkward inputs that every operator must take, and plain-Python rules to hold results against."""

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NAMES = ["id", "n", "key", "label", "token", "size", "shard", "slot", "kept", "n_words", "score", "row", "a", "b", "lo",
          "hi", "numbers", "__key", "__body", "__mark", "__text"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(n, start=0, stem="wort"):
    return " ".join(f"{stem}{i}" for i in range(start, start + n))


def odd_rows():
    """Nulls in any column, empty and very long texts, repeated rows, equal texts, Unicode at the edges."""
    base = words(120, stem="rund")
    near = base.replace("rund7 ", "eckig ")
    rows = [(1, base, "en", "s", 5), (2, None, "en", "s", None), (3, "", "en", None, 0), (None, words(60, 500), None, "s", 9),
            (4, base, None, "s", 5), (5, near, "en", "s", 5), (5, near, "en", "s", 5), (6, " \t\n\x0b ", "de", "s", 5),
            (7, (words(400, stem="lang") + "\n") * 40, "de", "s", 5), (8, "Ünï 😀 cödé \x1c\x85\xa0 ' 's x'll 12½", "fr", "s", 5),
            (9, "a b", "en", "s", 3), (10, "A  B", "en", "s", 4), (11, words(4), "en", "s", 4), (12, None, None, None, None),
            (13, "x" * 5000, "en", "s", 5000), (14, "line one is here for you\n\nline one is here for you\nend", "en", "s", 1)]
    return rows


def odd_docs(spark, clashes=True):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3, "n_chars")
    if clashes:
        docs = docs.withColumns({name: F.lit(7) for name in _NAMES})
    return docs


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


class Union:
    """Classes by merging, each named by its least member."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
