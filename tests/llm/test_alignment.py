"""Operator 11 against the tokenizer libraries, with links by byte ranges."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as public
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corvane.llm import alignment

from .cases import no_docs, odd_docs

A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


def _libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def _tokens(text, a, b, letters):
    """(ids, byte ends) of both tokenizers over the whole text at once."""
    if not text:
        return None
    want = (" " + text).encode()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in ids_b]
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None
    return ids_a, np.cumsum([len(x) for x in bytes_a]), ids_b, np.cumsum([len(x) for x in bytes_b])


def _plain(rows):
    a, b = _libraries()
    letters = alignment.byte_letters()
    held, count = [], Counter()
    for key, text in rows:
        got = _tokens(text, a, b, letters)
        pairs, shape, n_groups = [], "", 0
        if got:
            ids_a, ends_a, ids_b, ends_b = got
            i = j = 0
            while i < len(ids_a) and j < len(ids_b):
                pairs.append((ids_a[i], ids_b[j]))
                x, y = ends_a[i], ends_b[j]
                i, j = i + (x <= y), j + (y <= x)
            cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
            n_groups, parts = len(cuts), []
            sides = [Counter(), Counter()]
            for side, ids, ends in zip(sides, (ids_a, ids_b), (ends_a, ends_b)):
                for t, g in zip(ids, np.searchsorted(cuts, ends).tolist()):
                    side[g] = f"{side[g]},{t}" if side[g] else str(t)
            parts = [f"{sides[0][g]}|{sides[1][g]}" for g in range(n_groups)]
            shape = hashlib.sha256(";".join(parts).encode()).hexdigest()
        held.append((key, got, pairs, n_groups, shape))
        count.update(set(pairs))
    top = Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return sorted((str(key), len(got[0]) if got else 0, len(got[2]) if got else 0, n_groups, len(pairs),
                   sum(count[p] == top[p[0]] for p in pairs), sum(count[p] for p in pairs), shape)
                  for key, got, pairs, n_groups, shape in held)


def _result(docs):
    out = alignment.alignment(docs, A, B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((str(r[0]), *r[1:]) for r in out.collect())


ODD = ["", " ", "  ", "a ", "a  ", " a", "a▁b", "▁", "<s>x</s>", "<|endoftext|> x<|endoftext|>", "\x00a b", "a\n b\n\nc  ",
       "  x", "é 😀 中文 字", "tab\t x", "\x1c y \x85 z\xa0 w", "a᠎ b", "​ c", "don't we'll", "=" * 400, "�", "é ﬁ ½"]


def test_alignment_on_odd_rows(spark, monkeypatch):
    docs = odd_docs(spark).select("doc_id", "text", "n", "row", "label")
    more = [(100 + i, t, 1, 1, 1) for i, t in enumerate(ODD)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    want = _plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert _result(docs) == want
    monkeypatch.setattr(alignment, "frequent", lambda counts: 2)  # all pairs of one document are joined, not looked up
    assert _result(docs) == want
    assert alignment.alignment(no_docs(spark), A, B).count() == 0


def test_alignment_on_the_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 4000")
    assert _result(docs) == _plain([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_stretches_equal_whole_texts():
    """Random texts: encoded in stretches, with a memory that is emptied now and then, or by the libraries at once."""
    random.seed(4)
    alphabet = "ab's.  \t\n é1½!_’中😀\x1c\x85\xa0▁"
    values = ["".join(random.choices(alphabet, k=random.randint(0, 16))) for _ in range(4000)]
    a, b = _libraries()
    letters = alignment.byte_letters()
    both = alignment.Tokenizers(A, B)
    for at in range(0, len(values), 500):
        part = values[at:at + 500]
        if at % 1500 == 0:
            both.forget()
        got = both.encode(part)
        ends = [np.append(0, np.cumsum(got[n])) for n in ("n_a", "n_b")]
        for i, text in enumerate(part):
            want = _tokens(text, a, b, letters)
            assert bool(got["usable"][i]) == (want is not None), repr(text)
            mine = [got[x][e[i]:e[i + 1]].tolist() for x, e in zip("ab", ends)]
            assert mine == ([want[0], want[2]] if want else [[], []]), repr(text)


def _dense(m):
    out = np.zeros((len(m.ptr) - 1, m.width), int)
    for i in range(len(out)):
        out[i, m.col[m.ptr[i]:m.ptr[i + 1]]] = 1
    return out


@pytest.mark.parametrize("seed", range(5))
def test_products_equal_dense_ones(seed):
    rng = np.random.default_rng(seed)
    x, y = rng.random((7, 9)) < 0.3, rng.random((9, 6)) < 0.4
    a, b = (alignment.Csr(np.append(0, np.cumsum(m.sum(1))), np.nonzero(m)[1], m.shape[1]) for m in (x, y))
    rows, cols, n = alignment.gustavson(a, b)
    dense = np.zeros((7, 6), int)
    dense[rows, cols] = n
    assert (dense == x.astype(int) @ y.astype(int)).all()
    assert (_dense(alignment.transposed(a)) == x.T).all()
    nothing = alignment.incidence(np.zeros(0, np.int64))
    assert len(alignment.gustavson(nothing, alignment.transposed(nothing))[0]) == 0


def test_links_of_documents(spark):
    docs = spark.createDataFrame([(1, "Straße unbelievable 中"), (2, None), (3, "")], "doc_id bigint, text string")
    encoded = alignment.encode(docs, A, B)
    sizes = alignment.Tokenizers(A, B)
    row = {r["doc_id"]: r for r in encoded.collect()}[1]
    ends = [np.cumsum(s[np.array(row[i])]) for s, i in ((sizes.a_sizes, "a_ids"), (sizes.b_sizes, "b_ids"))]
    spans = [list(zip(np.append(0, e[:-1]), e)) for e in ends]
    common = {(i, j): min(p[1], q[1]) - max(p[0], q[0]) for i, p in enumerate(spans[0]) for j, q in enumerate(spans[1])}
    got = {r["doc_id"]: r for r in alignment.links(encoded, A, B).collect()}
    mine = got[1]
    assert dict(zip(zip(mine["a_at"], mine["b_at"]), mine["bytes"])) == {k: v for k, v in common.items() if v > 0}
    assert got[2]["a_at"] == got[3]["a_at"] == []
    cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    place = [[sum(c < e for c in cuts) for e in side] for side in ends]
    shared = {r["doc_id"]: r for r in alignment.links(encoded, A, B, "group").collect()}[1]
    assert sorted(zip(shared["a_at"], shared["b_at"])) == [(i, j) for i, x in enumerate(place[0]) for j, y in enumerate(place[1])
                                                          if x == y]
