"""Operators 5 and 9 against the tokenizer libraries."""

import base64
import hashlib
import random

import public_tokenizers as public
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from corvane.llm import bpe, codec, pretoken, token_counts

from .cases import no_docs, odd_docs, odd_rows

JSON, RANKS = public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken")
MULTI = public.path("byte_bpe_multi_50k.tiktoken")


def encoding(path):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_cuts_equal_the_pattern():
    random.seed(5)
    alphabet = "ab'stvrelmd' \t\n  é1½²!?-_’中😀\x1c\x85 ́"
    texts = ["".join(random.choices(alphabet, k=random.randint(0, 14))) for _ in range(20000)]
    joined, starts, ends, owner, _ = pretoken.pieces(texts)
    got = [[] for _ in texts]
    for a, b, i in zip(starts, ends, owner):
        got[i].append(joined[a:b])
    pattern = regex.compile(public.PATTERN)
    assert got == [pattern.findall(t) for t in texts]


@pytest.mark.parametrize("path", [RANKS, MULTI])
def test_merges_equal_the_library(path):
    random.seed(6)
    vocabulary, library = bpe.load(path), encoding(path)
    pieces = ["".join(random.choices("abcdeéxyz中=", k=k)) for k in [*range(1, 70), 300, 1023, 1024, 1025, 4000] * 3]
    pieces += ["a" * 3000, "=" * 700, "😀" * 50]
    got = vocabulary.encode([p.encode() for p in pieces])
    pattern = regex.compile(public.PATTERN)
    for piece, ids in zip(pieces, got):
        if len(pattern.findall(piece)) == 1:
            assert ids.tolist() == library.encode_ordinary(piece)
        assert vocabulary.decode(ids) == piece.encode()


def test_codec_on_odd_rows(spark):
    library = encoding(RANKS)
    want = sorted((str(i), len(library.encode_ordinary(t or "")),
                   sha(" ".join(map(str, library.encode_ordinary(t or ""))).encode()), sha((t or "").encode()))
                  for i, t, *_ in odd_rows())
    got = codec.encode(odd_docs(spark), RANKS, ids=True).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert all(len(r["ids"]) == r["n_tokens"] and sha(bytes(r["decoded"])) == r["decoded_sha256"] for r in got)
    assert codec.encode(no_docs(spark), RANKS).count() == 0


def test_counts_on_odd_rows(spark):
    tokenizer = Tokenizer.from_file(JSON)
    docs = odd_docs(spark).select("doc_id", "text", "n", "row")
    more = [(20, "a<|endoftext|>b <|endoftext|>", 1, 1), (21, "<|endoftext|>", 1, 1), (22, "new ՘ \U0001fae9 letters࢏", 1, 1)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()),
                   len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
    got = token_counts.token_counts(docs, JSON, limit=100).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)
    assert token_counts.token_counts(no_docs(spark), JSON).count() == 0


def test_counts_without_a_table_of_frequent_pieces(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(150)
    want = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, JSON).collect()}
    monkeypatch.setattr(token_counts, "frequent", lambda counts: 200)
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, JSON).collect()} == want
