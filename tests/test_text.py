"""Golden cases and properties of text functions, chunks, templates and tokens."""

import os
import random
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare  # noqa: E402

from corvane.functions import text as tx
from corvane.operators import chunks as ck
from corvane.operators import templates as tp
from corvane.operators import tokens as tk
from corvane.plans import load_all


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols)) if cols else spark.range(1)
    return df.select(expr.alias("v")).first()["v"]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def chunk_map(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], {})[r["chunk_ix"]] = r["chunk"]
    return out


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def test_lookback_golden(spark):
    got = chunk_map(ck.chunk_lookback(docs(spark, [LETTERS[:25], LETTERS[:22], "", "ab"]), 10, 2))
    assert got == {0: {0: LETTERS[0:10], 1: LETTERS[8:20], 2: LETTERS[18:25]},
                   1: {0: LETTERS[0:10], 1: LETTERS[8:20]}}


def test_stride_golden(spark):
    got = chunk_map(ck.chunk_stride(docs(spark, [LETTERS[:25]]), 10, 2))
    assert got == {0: {0: LETTERS[0:10], 1: LETTERS[8:18], 2: LETTERS[16:25]}}


def lookback_model(text, size, overlap):
    out, start = {}, 0
    for i in range(-(-len(text) // size)):
        piece = text[max(0, i * size - (overlap if i else 0)):(i + 1) * size]
        if len(piece) >= size // 2:
            out[i] = piece
    return out


@pytest.mark.parametrize("size,overlap", [(7, 0), (7, 3), (7, 6), (1, 0), (16, 16)])
def test_chunks_against_slices(spark, size, overlap):
    rng = random.Random(size * 31 + overlap)
    texts = ["".join(rng.choice("aé\n ß😀z") for _ in range(n)) for n in (0, 1, 6, 7, 8, 50, 333)]
    df = docs(spark, texts)
    look = chunk_map(ck.chunk_lookback(df, size, overlap))
    for i, text in enumerate(texts):
        assert look.get(i, {}) == lookback_model(text, size, overlap)
    if overlap < size:
        stride = chunk_map(ck.chunk_stride(df, size, overlap))
        step = size - overlap
        for i, text in enumerate(texts):
            want = {j: text[s:s + size] for j, s in enumerate(range(0, len(text), step)) if len(text[s:s + size]) >= size // 2}
            assert stride.get(i, {}) == want


def test_lookback_without_overlap_rebuilds_text(spark):
    text = "The quick brown fox. " * 40
    got = chunk_map(ck.chunk_lookback(docs(spark, [text]), 64, 10, min_len=1))[0]
    assert got[0] + "".join(got[i][10:] for i in sorted(got) if i) == text


def test_chunk_arguments(spark):
    with pytest.raises(ValueError):
        ck.chunk_lookback(docs(spark, ["a"]), 5, 6)
    with pytest.raises(ValueError):
        ck.chunk_stride(docs(spark, ["a"]), 5, 5)


def test_qa_windows_golden(spark):
    words = [f"w{i}" for i in range(600)]
    rows = sorted(ck.qa_windows(docs(spark, [" ".join(words), "  "])).collect(), key=lambda r: r["window_ix"])
    assert [len(r["context"].split()) for r in rows] == [512, 344, 88]
    assert rows[0]["question"] == "Summarize the following text: " + " ".join(words)[:100] + "..."
    assert rows[0]["answer"] == " ".join(words)[:512]


def test_token_windows_keep_short_tail(spark):
    words = [str(i) for i in range(463)]
    rows = sorted(ck.chunk_tokens(docs(spark, [" ".join(words)])).collect(), key=lambda r: r["chunk_ix"])
    assert [r["chunk"] for r in rows] == [" ".join(words), "462"]


def merge_model(text, sep, limit):
    out, cur = [], None
    for piece in [p for p in text.split(sep) if p]:
        if cur is None:
            cur = piece
        elif len(cur) + len(sep) + len(piece) <= limit:
            cur = cur + sep + piece
        else:
            out.append(cur)
            cur = piece
    if cur is not None:
        out.append(cur)
    return [c.strip() for c in out if c.strip()]


def test_merge_against_model(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = chunk_map(ck.chunk_merge(spark.createDataFrame(rows), "\n", 1000))
    for r in rows:
        assert [got.get(r["doc_id"], {})[i] for i in sorted(got.get(r["doc_id"], {}))] == merge_model(r["text"], "\n", 1000)


def test_merge_keeps_long_pieces_whole(spark):
    got = chunk_map(ck.chunk_merge(docs(spark, ["aa\n\n" + "x" * 30 + "\n\nbb\n\ncc"]), limit=10))
    assert got == {0: {0: "aa", 1: "x" * 30, 2: "bb\n\ncc"}}


def test_clean_and_lines(spark):
    assert one(spark, tx.clean_ws(F.col("t")), t="a\n\n\nb   c") == "a\nb c"
    assert one(spark, tx.drop_blank_lines(F.col("t")), t="a\n \n \n\nb ") == "a\nb "


def test_strip_and_words_follow_python(spark):
    text = "　\x1c a b\xa0c\x85 d \t​ e "
    assert one(spark, tx.strip(F.col("t")), t=text) == text.strip()
    assert one(spark, tx.words(F.col("t")), t=text) == text.split()
    assert one(spark, tx.token_message(F.col("t")), t="a b  c") == "This string has 3 tokens."


@pytest.mark.parametrize("name,slug,tag", [
    (" São Paulo-Morumbi ", "Sao Paulo Morumbi", "sao-paulo-morumbi"),
    ("Butantã", "Butanta", "butanta"),
    ("Pedro II", "Pedro II", "pedro-ii"),
    ("Weiß Łódź Ærø", "Weiss Lodz AEro", "weiss-lodz-aero")])
def test_slug(spark, name, slug, tag):
    assert one(spark, tx.slug(F.col("t")), t=name) == slug
    assert one(spark, tx.tag(F.col("t")), t=name) == tag


def test_keys(spark):
    assert one(spark, tx.actor_key(F.col("t")), t="Kasparov, Gary") == "kasparov"
    assert one(spark, tx.actor_key(F.col("t")), t="De La Cruz, X, Y") == "de_la_cruz"
    assert one(spark, tx.hex_id(F.lit("kasparov"), F.lit(777))) == "kasparov0x309"
    assert one(spark, tx.hex_id(F.lit(""), F.lit(5000))) == "0x1388"
    assert [one(spark, tx.zfill(F.lit(i), 3)) for i in (0, 42, 1234)] == ["000", "042", "1234"]


def test_answers(spark):
    mark, end = tx.ASSISTANT_MARK, tx.END_MARK
    cases = {"plain text": "plain text",
             f"x{mark}\nold{end}{mark}\n{tx.BOILERPLATE} new {end} tail": "new",
             f"x{mark}\n{tx.BOILERPLATE}\n{end}": tx.NO_ANSWER,
             f"{mark} open": "open"}
    for text, want in cases.items():
        assert one(spark, tx.extract_answer(F.col("t")), t=text) == want
    tail = tx.extract_answer(F.col("t"), "assistant\n", None, "", None)
    assert one(spark, tail, t="user\nq\nassistant\n the answer \n") == "the answer"
    assert one(spark, tx.strip_prefix(F.col("t"), F.col("p")), t="ab answer\n", p="xy") == "answer"
    assert one(spark, tx.remove_prompt(F.col("t"), F.col("p")), t="Q: a Q: b", p="Q:") == "a  b"


def test_templates(spark):
    assert one(spark, tp.render_qa(F.lit("q"), F.lit(""))) == "Question: q\nAnswer:"
    assert one(spark, tp.render_qa(F.lit("q"), F.lit(None).cast("string"))) == "Question: q\nAnswer:"
    assert one(spark, tp.render_qa(F.lit("q"), F.lit("c"))) == "Context: c\nQuestion: q\nAnswer:"
    msgs = one(spark, tp.to_messages(F.lit("do"), F.lit("this"), F.lit("done")))
    assert [(m["role"], m["content"]) for m in msgs] == [("user", "do\n Input: this"), ("assistant", "done")]
    text = one(spark, tp.apply_template(tp.to_messages(F.lit("a"), F.lit("b"), F.lit("c")), True))
    assert text == ("<|im_start|>user\na\n Input: b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n<|im_start|>assistant\n")
    rag = one(spark, tp.render_rag(F.lit("{context}"), F.lit("ctx"), "T", "A"))
    assert "QUESTION: {context}\nCONTEXT: ctx\n" in rag


def test_thread_parts_join_to_the_whole(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"m{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    parts = sorted(tp.render_threads(df, turns_per_part=7).collect(), key=lambda r: r["part"])
    assert len(parts) == 8
    assert "".join(p["chat"] for p in parts) == "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for _, _, r, x in rows)


def test_vocab_and_encode(spark):
    df = docs(spark, ["b a a <|im_end|>", "a c b", "", "a a a a a a a"])
    vocab = tk.build_vocab(df)
    rows = {r["token"]: (r["id"], r["added"]) for r in vocab.collect()}
    assert rows == {"a": (3, False), "b": (4, False), "<|im_end|>": (5, False), "c": (6, False), "<|im_start|>": (7, True)}
    small = vocab.filter("token <> 'c'")
    for head in (100, 2):
        out = {r["doc_id"]: r for r in tk.encode(df, small, 5, head=head).collect()}
        assert out[0]["input_ids"] == [4, 3, 3, 5, 2] and out[0]["attention_mask"] == [1, 1, 1, 1, 0]
        assert out[1]["input_ids"] == [3, 0, 4, 2, 2]
        assert out[2]["input_ids"] == [2] * 5 and out[2]["attention_mask"] == [0] * 5
        assert out[3]["input_ids"] == [3] * 5 and out[3]["labels"] == [3] * 5
    left = {r["doc_id"]: r for r in tk.encode(df, small, 5, side="left").collect()}
    assert left[1]["input_ids"] == [2, 2, 3, 0, 4] and left[1]["attention_mask"] == [0, 0, 1, 1, 1]


def test_batches_and_collation(spark):
    df = spark.range(10).select(F.col("id").alias("doc_id"), F.expr("sequence(3, 3 + cast(id as int))").alias("input_ids"))
    placed = tk.assign_batches(df, ["doc_id"], 2, 2)
    assert [(r["batch"], r["step"]) for r in placed.orderBy("doc_id").collect()] == [(i // 2, i // 4) for i in range(10)]
    out = tk.collate(placed, "batch", 8).orderBy("doc_id").collect()
    assert [r["width"] for r in out] == [8] * 8 + [16] * 2
    assert all(len(r["input_ids"]) == r["width"] == len(r["labels"]) for r in out)
    assert out[0]["labels"] == [3] + [-100] * 7
    longest = tk.pad_to_longest(placed, "batch").orderBy("doc_id").collect()
    assert [len(r["input_ids"]) for r in longest] == [2, 2, 4, 4, 6, 6, 8, 8, 10, 10]


def test_long_rows_stay_whole_without_cut(spark):
    df = docs(spark, ["a " * 9, "b a"])
    vocab = tk.build_vocab(df, specials=())
    for head in (100, 1):
        whole = {r["doc_id"]: r for r in tk.encode(df, vocab, 5, head=head, cut=False).collect()}
        assert whole[0]["input_ids"] == [3] * 9 == whole[0]["labels"] and whole[0]["attention_mask"] == [1] * 9
        assert whole[1]["input_ids"] == [4, 3, 2, 2, 2] and whole[1]["attention_mask"] == [1, 1, 0, 0, 0]
        assert {len(r["input_ids"]) for r in tk.encode(df, vocab, 5, head=head).collect()} == {5}


def test_queries_keep_chunks_of_many_short_words(spark, tmp_path):
    """A chunk of 1,024 characters and 100 of overlap may hold 562 words, more than the 512 ids of a padded row."""
    text = "a " * 2000
    spark.createDataFrame([(1, text, "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long") \
        .coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    for name in ("t14_encode", "t14_training_rows", "t14_no_token_lost", "t15_encode_left", "t15_pad_to_longest", "t16_collate", "a18_profile"):
        query = load_all()[name]
        assert compare(query.run(spark, str(tmp_path)), con, query.sql) == [], name


def test_encode_beyond_the_head_keeps_rows_apart(spark):
    """words outside the broadcast head leave and meet their row by its number, so rows of one key stay two."""
    long = "x" * 70
    rows = [(1, "a b c a"), (1, f"a {long} z"), (None, "q a r q"), (4, ""), (5, None), (6, "a a"), (7, f"z {long} nowhere")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    vocab = tk.build_vocab(df.filter("doc_id is null or doc_id <> 7"), specials=())
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    for length, cut in ((3, True), (3, False)):
        want = []
        for key, text in rows:
            mine = [ids.get(w, tk.UNK_ID) for w in (text or "").split()]
            mine = mine[:length] if cut else mine
            want.append((key, mine + [tk.EOS_ID] * (length - len(mine))))
        for head in (1, 2, 100):
            got = [(r["doc_id"], r["input_ids"]) for r in tk.encode(df, vocab, length, head=head, cut=cut).collect()]
            assert sorted(got, key=str) == sorted(want, key=str)
