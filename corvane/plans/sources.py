"""Source and sink queries."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import functions as F

from corvane.functions import arrays as ar
from corvane.operators import sequences as sq
from corvane.operators import splits as sp
from corvane.plans import query
from corvane.scale import scratch_path
from corvane.sources import files, pages, records, tables

_XMLNS = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def _docx(text):
    """A minimal document with one paragraph per line."""
    body = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>' for line in text.split("\n"))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{_XMLNS}"><w:body>{body}</w:body></w:document>')
    return buffer.getvalue()


@query("s1_scan_corpus", "SELECT lang, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY lang")
def s1(t):
    path = scratch_path(t.spark, "corpus")
    t("documents").select("doc_id", "lang", "n_chars").write.partitionBy("lang").option("maxRecordsPerFile", 100_000).json(path)
    found = files.scan_corpus(t.spark, path, "*.json", recursive=True)
    lines = found.select(F.regexp_extract("path", "lang=(\\w+)", 1).alias("lang"),
                         F.explode(F.split(F.rtrim(F.col("content").cast("string")), "\n")).alias("line"))
    row = F.from_json("line", "doc_id long, n_chars long")
    return lines.filter("line <> ''").select("lang", row["n_chars"].alias("n")).groupBy("lang").agg(
        F.count("*").alias("n_rows"), F.sum("n").alias("n_chars"))


_PATHS = """(SELECT doc_id, source || '/' || doc_id || CASE lang WHEN 'en' THEN '.docx' WHEN 'fr' THEN '.PDF'
    WHEN 'de' THEN '.DOCX' ELSE '.txt' END AS path FROM documents)"""


@query("s2_route", f"""
    SELECT doc_id, CASE WHEN lower(path) LIKE '%.pdf' THEN 'pdf' WHEN lower(path) LIKE '%.docx' THEN 'docx' ELSE 'unsupported' END AS kind,
           CASE WHEN path LIKE '%.docx' THEN 'docx' ELSE 'text' END AS loose FROM {_PATHS}""")
def s2(t):
    suffix = F.when(F.col("lang") == "en", ".docx").when(F.col("lang") == "fr", ".PDF").when(
        F.col("lang") == "de", ".DOCX").otherwise(".txt")
    named = t("documents").select("doc_id", F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), suffix).alias("path"))
    strict = files.route(named)
    return strict.withColumn("loose", files.kind(F.col("path"), "text", ignore_case=False, pdf=False)).drop("path")


@query("s3_extract_docx", "SELECT doc_id, text, NULL::VARCHAR AS error FROM documents")
def s3(t):
    make = F.udf(_docx, "binary", useArrow=False)
    made = t.spread("documents", "doc_id").select("doc_id", make("text").alias("content"))
    return files.extract_docx(made, "doc_id")


@query("s4_json_round_trip", "SELECT conv_id, turn, role, text FROM conversations")
def s4(t):
    path = scratch_path(t.spark, "json")
    tables.write_json(t("conversations"), path)
    return tables.read_json(t.spark, path).select("conv_id", "turn", "role", "text")


@query("s5_flatten_props", "SELECT event_id, 'k' AS key, (props->>'$.k')::DOUBLE AS value FROM events")
def s5(t):
    nested = t("events").select("event_id", F.concat(F.lit('{"k": {"value": '), F.get_json_object("props", "$.k"), F.lit("}}")).alias("j"))
    return tables.flatten_records(nested, "j", "struct<value double>")


@query("s5_flatten_stations", """
    SELECT s_suppkey::VARCHAR AS station, s_name AS name, s_nationkey::VARCHAR AS number, n_name AS line,
           s_acctbal AS lat, s_nationkey::DOUBLE AS lon FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def s5_stations(t):
    s = t("supplier").join(t("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey")
    record = F.struct(
        F.col("s_name").alias("title"),
        F.array(F.concat(F.lit("linha-"), F.col("s_nationkey").cast("string"), F.lit("-"), "n_name")).alias("lines"),
        F.struct(F.col("s_acctbal").cast("string").alias("latitude"), F.col("s_nationkey").cast("string").alias("longitude")).alias("location"))
    raw = s.select(F.to_json(F.create_map(F.col("s_suppkey").cast("string"), record)).alias("j"))
    flat = tables.flatten_stations(raw, "j")
    return flat.withColumns({"number": F.element_at("number", 1), "line": F.element_at("line", 1)})


def _enriched(t):
    return t("customer").select("c_custkey", "c_name", F.array("c_mktsegment", F.col("c_nationkey").cast("string")).alias("tags"))


@query("s6_export_csv", """SELECT c_custkey, c_name, '["' || c_mktsegment || '","' || c_nationkey || '"]' AS tags FROM customer""")
def s6(t):
    path = scratch_path(t.spark, "csv")
    tables.export(_enriched(t), path, "csv")
    return t.spark.read.schema("c_custkey long, c_name string, tags string").option("header", "true").option("escape", '"').csv(path)


@query("s6_export_json", "SELECT c_custkey, c_name, c_mktsegment || ' ' || c_nationkey AS tags FROM customer")
def s6_json(t):
    path = scratch_path(t.spark, "json")
    tables.export(_enriched(t), path, "json")
    back = tables.read_json(t.spark, path, "c_custkey long, c_name string, tags array<string>")
    return back.withColumn("tags", F.array_join("tags", " "))


@query("s7_save_load", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def s7(t):
    path = scratch_path(t.spark, "table")
    tables.save_table(t("orders"), path)
    return tables.load_table(t.spark, path)


@query("s8_load_split", """
    SELECT doc_id, lang, 'test' AS split FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY md5(doc_id || ':1234')) AS r,
      count(*) OVER () AS n FROM documents) WHERE r <= ceil(n * 0.05::DOUBLE)""")
def s8(t):
    root = scratch_path(t.spark, "datasets")
    train, test = sp.split(t("documents").select("doc_id", "lang"), 0.05, 1234, ["doc_id"])
    tables.save_table(train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test"))),
                      f"{root}/corpus", "split")
    return tables.load(t.spark, root, "corpus", "test")


@query("s9_parse_game_records", """
    SELECT doc_id, 'Event ' || doc_id AS event, source AS white, lang AS black, n_moves, first_move, md5(moves) AS moves_md5 FROM (
      SELECT doc_id, source, lang, len(m)::INT AS n_moves, m[1] AS first_move, array_to_string(m, ' ') AS moves FROM (
        SELECT doc_id, source, lang, list_filter(list_transform(regexp_split_to_array(translate(text, '[{();$', '______'), '\\s+'),
          lambda w: regexp_replace(w, '^[0-9]+\\.+', '')),
          lambda w: w <> '' AND w NOT IN ('1-0', '0-1', '1/2-1/2', '*')) AS m FROM documents WHERE lang <> 'de'))""")
def s9(t):
    """Documents written as one record file: players are source and language, moves the words.
    German records lack a player and must be skipped."""
    path = scratch_path(t.spark, "records")
    text = F.translate("text", "[{();$", "______")
    black = F.when(F.col("lang") == "de", "").otherwise(F.concat(F.lit('[Black "'), "lang", F.lit('"]\n')))
    record = F.concat(F.lit('[Event "Event '), F.col("doc_id").cast("string"), F.lit('"]\n[White "'), "source", F.lit('"]\n'),
                      black, F.lit("\n1. "), text, F.lit(" 1-0"))
    t("documents").select(record.alias("value")).write.option("lineSep", "\n\n").text(path)
    games = records.read_game_records(t.spark, path)
    return games.select(
        F.regexp_extract(F.col("headers")["Event"], "(\\d+)", 1).cast("bigint").alias("doc_id"),
        F.col("headers")["Event"].alias("event"), F.col("headers")["White"].alias("white"),
        F.col("headers")["Black"].alias("black"), F.size("moves").alias("n_moves"), F.get("moves", F.lit(0)).alias("first_move"),
        F.md5(F.array_join("moves", " ")).alias("moves_md5"))


@query("s10_load_until_repeat", """
    WITH a AS (SELECT 0 AS source, o_orderkey AS pos, o_orderstatus AS v FROM orders UNION ALL
               SELECT 1, c_custkey, c_mktsegment FROM customer UNION ALL SELECT 2, p_partkey, p_brand FROM part)
    SELECT source, pos, v FROM (SELECT *, sum((v = p)::INT) OVER (PARTITION BY source ORDER BY pos) AS reps FROM (
      SELECT *, lag(v) OVER (PARTITION BY source ORDER BY pos) AS p FROM a)) WHERE coalesce(reps, 0) = 0""")
def s10(t):
    frames = [t(n).select(F.col(k).alias("pos"), F.col(v).alias("v"))
              for n, k, v in (("orders", "o_orderkey", "o_orderstatus"), ("customer", "c_custkey", "c_mktsegment"),
                              ("part", "p_partkey", "p_brand"))]
    return sq.take_until_repeat(records.load_ordered(*frames), ["source"], ["pos"], "v").select("source", "pos", "v")


_HREFS = ("regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>', '', 'g'), "
          "'(?i)<a\\s[^>]*?\\bhref\\s*=\\s*[\"\\x27]([^\"\\x27]*)[\"\\x27]', 1)")


@query("s11_extract_links", f"""
    SELECT page_id, (i - 1)::INT AS link_ix, replace(h[i], '&amp;', '&') AS href FROM (
      SELECT page_id, h, unnest(generate_series(1, len(h))) AS i FROM (
        SELECT page_id, {_HREFS} AS h FROM pages))""")
def s11(t):
    return pages.extract_links(t("pages"))


@query("s11_first_link", f"""
    SELECT page_id, min(i - 1)::INT AS link_ix, replace(arg_min(h[i], i), '&amp;', '&') AS href FROM (
      SELECT page_id, h, unnest(generate_series(1, len(h))) AS i FROM (
        SELECT page_id, {_HREFS} AS h FROM pages))
    WHERE contains(h[i], 'th') GROUP BY page_id""")
def s11_first(t):
    return pages.first_link(pages.extract_links(t("pages")), "th")


@query("s11_element_text", """
    SELECT page_id, nullif(regexp_extract(html, '(?s)<(?:title)>([^<]*)<', 1), '') AS title FROM pages""")
def s11_title(t):
    return pages.element_text(t("pages"), "title", "title").select("page_id", "title")


@query("s11_article_text", """
    SELECT page_id, replace(replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', '', 'g'),
           '&quot;', '"'), '&amp;', '&') AS text FROM pages""")
def s11_article(t):
    """Whole articles with all that is nested in them; the pages leave many of the tags inside open."""
    return pages.whole_text(t("pages"), tag="article").select("page_id", "text")


@query("s11_extract_by_id", "SELECT page_id, length(url) / 100.0::DOUBLE AS lat FROM pages")
def s11_id(t):
    number = F.format_string("%d,%02d", F.floor(F.length("url") / 100), F.length("url") % 100)
    span = F.concat(F.lit('<span class="c" id="lblLatitude">'), number, F.lit("</span>"))
    marked = t("pages").select("page_id", F.concat("html", span).alias("html"))
    return pages.extract_by_id(marked, "lblLatitude", "lat").select("page_id", "lat")


def _u(key: str, seed: int) -> str:
    return f"(('0x' || substr(md5({key} || ':{seed}'), 1, 15))::BIGINT::DOUBLE / 1152921504606846976.0::DOUBLE)"


def _normal(key: str, i: int, seed: int) -> str:
    return (f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {_u(key, seed + 2 * i)})) * "
            f"cos(6.283185307179586::DOUBLE * {_u(key, seed + 2 * i + 1)})")


_X = f"({_u('event_id', 133)} * 20.0::DOUBLE - 10.0::DOUBLE)"


@query("s12_synthetic_columns", "SELECT event_id, (" + _u("event_id", 32) + " < 0.25)::INT AS y, " + ", ".join(
    f"round({_normal('event_id', i, 33)}" + (f" + ({_u('event_id', 32)} < 0.25)::INT - 0.5::DOUBLE" if i < 4 else "")
    + f", 6) AS x{i}" for i in range(9) if i != 4) + f""",
    round(2.0::DOUBLE * exp(1.0::DOUBLE / (abs({_X}) + 1.0::DOUBLE)) * sin(0.1::DOUBLE * {_X} * {_X})
      + 0.5::DOUBLE * {_normal('event_id', 101, 33)}, 6) AS x4 FROM events""")
def s12(t):
    out = tables.synth_columns(t("events").select("event_id"), "event_id", 33)
    return out.withColumns({f"x{i}": F.round(f"x{i}", 6) for i in range(9)})
