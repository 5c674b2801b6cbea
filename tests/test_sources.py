"""Readers and writers on small files."""

import io
import os
import sys
import zipfile
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare  # noqa: E402

from corvane import scale
from corvane.plans import load_all
from corvane.sources import files, pages, records, tables
from corvane.streaming import state as ss

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
GAMES = '''[Event "Club A"]
[Site "Harbour"]
[White "Fern, Olive"]
[Black "Moss, Ida"]
[Result "1-0"]
[ECO "A00"]

1.g3 d5 2.Bg2 $1 e5 (2... c6 3. d3 (3. Nf3 Bg4) Nf6) 3.d3 ; a quiet line
Nf6 {a comment} 4.Nf3 Nc6  1-0

[Event "No partner"]
[White "Nobody"]

1.a3 a6 *

[Event "Second"]
[White "Moss, Ida"]
[Black "Reed, Tom"]
[Black "Fern, Olive"]

1. f4 Nf6 2. e3 e6 1/2-1/2
'''


def docx(*paragraphs):
    body = "".join(f"<w:p>{p}</w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{W}"><w:body>{body}<w:tbl><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tbl></w:body></w:document>')
    return out.getvalue()


def run(text):
    return f"<w:r><w:t>{text}</w:t></w:r>"


def test_scan_route_and_extract(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(docx(run("one") + run(" more"), run("  "), "<w:r><w:t>x</w:t><w:tab/><w:t>y</w:t></w:r>"))
    (tmp_path / "bad.docx").write_bytes(b"not a zip")
    (tmp_path / "c.txt").write_text("líne 1\nline 2")
    found = files.scan_corpus(spark, str(tmp_path))
    got = {r["path"].rsplit("/", 1)[1]: r for r in files.extract_docx(found).collect()}
    assert set(got) == {"a.docx", "bad.docx"}
    assert got["a.docx"]["text"] == "one more\n  \nx\ty" and got["a.docx"]["error"] is None
    assert got["bad.docx"]["text"] == "" and "BadZipFile" in got["bad.docx"]["error"]
    dropped = {r["path"].rsplit("/", 1)[1]: r["text"] for r in files.extract_docx(found, drop_blank=True).collect()}
    assert dropped["a.docx"] == "one more\nx\ty"
    assert files.read_texts(spark, str(tmp_path), "*.txt").first()["text"] == "líne 1\nline 2"


def test_route(spark):
    df = spark.createDataFrame([(p,) for p in ("a.pdf", "b.DOCX", "c.docx", "d.txt")], "path string")
    assert [r["kind"] for r in files.route(df).collect()] == ["pdf", "docx", "docx", "unsupported"]
    assert [r["kind"] for r in files.route(df, strict=False).collect()] == ["text", "text", "docx", "text"]


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_records(spark, tmp_path, ends):
    (tmp_path / "games.txt").write_bytes(GAMES.replace("\n", ends).encode())
    got = {r["headers"]["Event"]: r for r in records.read_game_records(spark, str(tmp_path)).collect()}
    assert set(got) == {"Club A", "Second"}
    assert got["Club A"]["moves"] == ["g3", "d5", "Bg2", "e5", "d3", "Nf6", "Nf3", "Nc6"]
    assert got["Club A"]["headers"]["ECO"] == "A00" and got["Club A"]["headers"]["Black"] == "Moss, Ida"
    assert got["Second"]["moves"] == ["f4", "Nf6", "e3", "e6"]
    assert got["Second"]["headers"]["Black"] == "Fern, Olive"
    assert records.read_game_records(spark, str(tmp_path), cap=1).count() == 1


def test_undecodable_record_is_skipped(spark, tmp_path):
    third = GAMES.split("\n\n[Event ")[2].encode().replace(b"f4", b"f4\xff\xfe")
    whole = GAMES.encode() + b"\n[Event " + third + b"\n"
    (tmp_path / "games.txt").write_bytes(whole)
    got = [r["headers"]["Event"] for r in records.read_game_records(spark, str(tmp_path)).collect()]
    assert sorted(got) == ["Club A", "Second"]


def test_stream_of_records_equals_batch(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"g{i}.txt").write_text(GAMES.replace("Second", f"Second {i}"))
    batch = records.read_game_records(spark, str(tmp_path))
    stream = ss.run_available(ss.stream_records(spark, str(tmp_path), max_files=2), "test")
    rows = [sorted((r["headers"]["Event"], tuple(r["moves"])) for r in df.collect()) for df in (batch, stream)]
    assert rows[0] == rows[1] and len(rows[0]) == 10


def test_json_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b', ["x", "y"]), (2, "line\nbreak", [])], "id long, s string, l array<string>")
    tables.write_json(df, str(tmp_path / "j"))
    assert sorted(map(tuple, tables.read_json(spark, str(tmp_path / "j")).select("id", "s").collect())) == [(1, 'a "q", b'), (2, "line\nbreak")]
    (tmp_path / "arr.json").write_text('[{"question": "q", "answer": "a"}, {"question": "r", "answer": "b"}]')
    assert tables.read_json(spark, str(tmp_path / "arr.json"), multiline=True).count() == 2
    tables.export(df, str(tmp_path / "c"), "csv")
    back = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(str(tmp_path / "c"))
    assert {r["id"]: (r["s"], r["l"]) for r in back.collect()} == {"1": ('a "q", b', '["x","y"]'), "2": ("line\nbreak", "[]")}
    with pytest.raises(ValueError):
        tables.export(df, str(tmp_path / "x"), "xml")


def test_stations(spark):
    raw = ('{"se": {"title": "Sé", "lines": ["linha-1-azul", "linha-3-vermelha"], "location": {"latitude": "-23.5", "longitude": "-46.6"}},'
           ' "luz": {"title": "Luz", "lines": ["linha-1-azul"], "location": {"latitude": "x", "longitude": "1"}}}')
    got = {r["station"]: r for r in tables.flatten_stations(spark.createDataFrame([(raw,)], "j string"), "j").collect()}
    assert got["se"]["line"] == ["azul", "vermelha"] and got["se"]["number"] == ["1", "3"]
    assert (got["se"]["lat"], got["luz"]["lat"], got["luz"]["lon"]) == (-23.5, None, 1.0)


def test_split_load_prunes(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 3, "test").otherwise("train"))
    tables.save_table(df, str(tmp_path / "d"), "split")
    assert tables.load(spark, str(tmp_path), "d", "test").count() == 3
    assert tables.load(spark, str(tmp_path), "d").count() == 10


def test_pages(spark):
    html = '''<a class="x" href="/one">1</a><A HREF='/two?a&amp;b'>2</A><!-- <a href="/no">n</a> --><a href="/Marker/3">3</a><span id="lat" class="q"> -23,55 </span><title>T</title>'''
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page_id long, html string")
    links = pages.extract_links(df)
    assert [r["href"] for r in links.orderBy("link_ix").collect()] == ["/one", "/two?a&b", "/Marker/3"]
    assert [(r["page_id"], r["link_ix"]) for r in pages.first_link(links, "Marker").collect()] == [(1, 2)]
    assert {r["page_id"]: r["value"] for r in pages.extract_by_id(df, "lat").collect()} == {1: -23.55, 2: None}


PAGE = """<html><head><title>a < b</title><script>var x = '<div id="box">no</div>';</script></head><body>
<!-- <div id="box">hidden</div> --><p title='1 > 0 id="box"'>one<p data-id="box">two
<DIV class=x ID = 'box'>A <b>bold &amp;<div>in <i>deep</div> tail<br/><img src="x>y.png"> <!-- </div> -->end<style>b{}</style></div>after
<span id=bare>bare</span><ul id="l"><li>1<li>2<ul><li>3</li></ul></ul><p id="open">rest <b>of it</div></p>x<i id="z">to the end"""


def test_whole_text_of_nested_elements(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<p"), (5, '<p id="box')], "page_id long, html string")

    def text(**want):
        return {r["page_id"]: r["text"] for r in pages.whole_text(df, **want).collect()}

    assert text(element_id="box") == {1: "A bold &in deep tail end", 2: None, 3: None, 4: None, 5: None}
    found = {k: text(element_id=k)[1] for k in ("bare", "l", "open", "z", "none")}
    assert found == {"bare": "bare", "l": "123", "open": "rest of it", "z": "to the end", "none": None}
    assert text(tag="title")[1] == "a < b" and text(tag="p")[1] == "one" and text(tag="DIV", element_id="bare")[1] is None
    assert text(tag="br")[1] == "" and text(tag="img", element_id="box")[1] is None
    deep = spark.createDataFrame([("<div id='r'>" + "<div>x" * 20000 + "</div>" * 20000 + "y</div>z" + "<a" * 50000,)], "html string")
    assert pages.whole_text(deep, element_id="r").first()["text"] == "x" * 20000 + "y"


def test_variations_of_any_depth(spark):
    nested = "1. e4 " + "(1. d4 " * 30 + "d5" + ") c5 " * 29 + ") e5 2. Nf3 (2. f4 (2. Bc4) exf4) Nc6 1-0"
    rows = [(1, nested), (2, "e4) e5 () d4"), (3, "e4 (e5 d4"), (4, ""), (5, None), (6, "{a (b} e4 ; ( c\n e5")]
    df = spark.createDataFrame(rows, "id int, t string").select("id", records.moves(F.col("t")).alias("m"))
    assert {r["id"]: r["m"] for r in df.collect()} == {
        1: ["e4", "e5", "Nf3", "Nc6"], 2: ["e4", "e5", "d4"], 3: ["e4"], 4: [], 5: None, 6: ["e4", "e5"]}


def test_synth_is_stable(spark):
    df = tables.synth(spark, 2000, 33)
    assert df.columns == [f"x{i}" for i in range(9)] + ["y"]
    share = df.agg(F.avg("y")).first()[0]
    assert 0.2 < share < 0.3
    ids = spark.range(300)
    rows = lambda d: sorted(map(tuple, tables.synth_columns(d, "id", 1).collect()))
    assert rows(ids.repartition(2)) == rows(ids.repartition(7))


def test_empty_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert ss.run_available(ss.stream_records(spark, str(tmp_path / "in")), "test").count() == 0


def session_stub(checkpoint_dir, master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: checkpoint_dir or default),
                           sparkContext=SimpleNamespace(applicationId=f"app-{master}", master=master))


def test_shared_folder_follows_the_session(spark):
    assert scale.shared_dir(session_stub("hdfs://c/ckpt/", "yarn")) == "hdfs://c/ckpt"
    with pytest.raises(RuntimeError):
        scale.shared_dir(session_stub(None, "yarn"))
    local = session_stub(None, "local[2]")
    assert scale.shared_dir(local) == scale.shared_dir(local)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scale.scratch_path(spark, "x").startswith(configured.rstrip("/") + "/x-")
    assert scale.materialize(spark.range(5)).count() == 5


def test_running_state_over_batches(spark, tmp_path):
    turns = [(c, t, ("system", "user", "assistant")[t % 3], f"m{c}{t}") for c in range(4) for t in range(6)]
    schema = "conv_id long, turn long, role string, text string"
    for part in range(3):  # turns of every thread arrive in three files
        spark.createDataFrame([x for x in turns if x[1] // 2 == part], schema).coalesce(1).write.mode("append").parquet(str(tmp_path))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    got = {(r["conv_id"], r["turn"]): (r["n_system"], r["n_user"], r["n_assistant"], r["n_chars"], r["n_messages"], r["last_text"])
           for r in ss.run_available(ss.stream_running_state(stream), "test").collect()}
    assert got == {(c, t): ((t + 3) // 3, (t + 2) // 3, (t + 1) // 3, 3 * (t + 1), t + 1, f"m{c}{t}")
                   for c, t, _, _ in turns}


def test_q_update_replays_the_model(spark, sf, tmp_path):
    steps = spark.read.parquet(f"{sf}/events.parquet").filter("user_id < 12").select(
        "user_id", "ts", "event_id", F.col("event_type").alias("s"), (F.col("event_id") % 3).cast("string").alias("a"), F.col("value").alias("r"))
    rows = sorted(steps.collect(), key=lambda r: (r["ts"], r["event_id"]))
    half = len(rows) // 2
    for part in (rows[:half], rows[half:]):
        spark.createDataFrame(part, steps.schema).coalesce(1).write.mode("append").parquet(str(tmp_path))
    stream = spark.readStream.schema(steps.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    got = {r["event_id"]: r["w"] for r in ss.run_available(ss.stream_q_update(stream, 0.9), "test").collect()}
    want, per_user = {}, {}
    for r in rows:
        w, n, last = per_user.get(r["user_id"], ({}, 0, None))
        if last is not None:
            n += 1
            alpha = 50 / (50 + 1 / n ** 0.5)
            k = (last["s"], last["a"])
            w[k] = w.get(k, 0) + alpha * (last["r"] + 0.9 * w.get((r["s"], last["a"]), 0) - w.get(k, 0))
            want[last["event_id"]] = w[k]
        per_user[r["user_id"]] = (w, n, r)
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_streams_read_tables_of_one_file_and_of_many(spark, sf, tmp_path):
    from corvane.plans import load_all
    for name in ("conversations", "events"):
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(4, F.rand(3)).write.parquet(f"{tmp_path}/{name}.parquet")
    for query in ("st1_running_state", "st2_q_update"):
        run = load_all()[query].run
        assert sorted(run(spark, str(tmp_path)).collect()) == sorted(run(spark, sf).collect())


def test_workers_need_no_package_on_their_path(tmp_path, sf):
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (f"import sys; sys.path.insert(0, {root!r})\n"
              "from corvane.session import local_session\nfrom corvane.plans import load_all\n"
              "spark = local_session(2, 'away', '2g')\n"
              "for q in ('t5_chunk_merge', 'j5_top_k_cosine', 'a12_rouge_l', 's3_extract_docx', 'st1_running_state'):\n"
              f"    print(q, load_all()[q].run(spark, {sf!r}).limit(3).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split().count("3") == 5, done.stderr[-2000:]


def test_references_without_an_end_stay(spark):
    html = '<article>a&ampb &amp;quot; &ltc; &#39;&#x41;&nosuch; &amp</article>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert pages.whole_text(df, tag="article").first()["text"] == "a&ampb &quot; &ltc; 'A&nosuch; &amp"


def test_article_query_on_cut_references(spark, tmp_path):
    rows = [(1, "<article><p>a&ampb &amp;&quot;</p><p>c</article>"), (2, "<article>&amp;amp;</article>")]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    assert against_sql(spark, tmp_path, "pages", "s11_article_text") == []


def test_game_query_on_texts_that_begin_like_a_move(spark, tmp_path):
    texts = ["44.144.126.223 a", ".5 b", "12. c", "d\re\r\nf", "3.14", "1-0 g", ""]
    rows = [(i, x, "en", "s", len(x)) for i, x in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert against_sql(spark, tmp_path, "documents", "s9_parse_game_records") == []


def against_sql(spark, folder, table, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    query = load_all()[name]
    return compare(query.run(spark, str(folder)), con, query.sql)


def test_record_stream_query_on_texts_that_begin_like_a_move(spark, tmp_path):
    rows = [(1, i, "user", x) for i, x in enumerate(["44. a", "3.", "1-0 b", ".. c", "d\re"])]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    assert against_sql(spark, tmp_path, "conversations", "st3_stream_records") == []
