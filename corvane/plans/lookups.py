"""Lookup, distance, retrieval and pairing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import arrays as ar
from corvane.operators import lookup as lk
from corvane.operators import retrieval as rt
from corvane.operators import rows as rw
from corvane.operators import stats as st
from corvane.operators import templates as tp
from corvane.operators.vector_index import VectorIndex
from corvane.plans import query
from corvane.plans.rows import BOARD, board, sql_map
from corvane.scale import lookup_join, materialize


@query("j1_encode_symbols", f"""
    SELECT vec_id, array_to_string(list_transform({BOARD}, lambda x: {sql_map(ar.PIECE_CODES)}[x]), ' ') AS state FROM embeddings""")
def j1(t):
    return t("embeddings").select("vec_id", F.array_join(ar.encode_symbols(board(), ar.PIECE_CODES), " ").alias("state"))


@query("j1_pass_through", """
    SELECT event_id, CASE event_type WHEN 'click' THEN '10' WHEN 'view' THEN '-20' ELSE event_type END AS event_type FROM events""")
def j1_pass(t):
    return lk.encode_column(t("events").select("event_id", "event_type"), "event_type", {"click": 10, "view": -20})


@query("j1_lookup_table", """
    SELECT l_orderkey, l_linenumber, coalesce(p_brand, l_partkey::VARCHAR) AS brand
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON l_partkey = p_partkey""")
def j1_table(t):
    table = t("part").filter("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lk.encode_from(rows, "l_partkey", table, "brand").drop("l_partkey")


_DECODE = {c: "/".join(n) for c, *n in ar.WEIGHT_PIECES}


@query("j2_decode_values", f"""
    SELECT vec_id, array_to_string(list_transform({BOARD}, lambda x: {sql_map(_DECODE)}[{sql_map(ar.PIECE_WEIGHTS)}[x]]), ' ') AS pieces
    FROM embeddings""")
def j2(t):
    codes = ar.encode_symbols(board(), ar.PIECE_WEIGHTS)
    return t("embeddings").select("vec_id", F.array_join(ar.decode_values(codes, ar.WEIGHT_PIECES), " ").alias("pieces"))


@query("j2_last_wins", "SELECT p_size, arg_max(p_name, p_partkey) AS p_name FROM part GROUP BY p_size")
def j2_last(t):
    return lk.last_wins(t("part"), "p_size", "p_name", "p_partkey")


# Nations as places: mean customer balance and mean supplier balance are the coordinates.
# An edge joins a customer's nation to a supplier's nation traded with more often than average.
PLACES = """nodes AS (SELECT n_nationkey AS id, x, y FROM nation
      JOIN (SELECT c_nationkey, avg(c_acctbal) AS x FROM customer GROUP BY 1) ON c_nationkey = n_nationkey
      JOIN (SELECT s_nationkey, avg(s_acctbal) AS y FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey),
    pairs AS (SELECT c_nationkey AS src, s_nationkey AS dst, count(*) AS n FROM lineitem
      JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
      WHERE c_nationkey <> s_nationkey GROUP BY ALL),
    links AS (SELECT src, dst FROM pairs WHERE n > (SELECT avg(n) FROM pairs)),
    edge AS (SELECT src, dst, sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y)) AS cost
      FROM links JOIN nodes a ON a.id = src JOIN nodes b ON b.id = dst)"""


def places(t):
    x = t("customer").groupBy(F.col("c_nationkey").alias("id")).agg(F.avg("c_acctbal").alias("x"))
    y = t("supplier").groupBy(F.col("s_nationkey").alias("id")).agg(F.avg("s_acctbal").alias("y"))
    return t("nation").select(F.col("n_nationkey").alias("id")).join(x, "id").join(y, "id")


def trade_links(t):
    customer = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("src"))
    supplier = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("dst"))
    orders = lookup_join(t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), customer, ["o_custkey"], "inner")
    lines = lookup_join(t("lineitem").select("l_orderkey", "l_suppkey"), supplier, ["l_suppkey"], "inner")
    pairs = (lookup_join(lines, orders.select("l_orderkey", "src"), ["l_orderkey"], "inner").filter("src <> dst")
             .groupBy("src", "dst").agg(F.count("*").alias("n")))
    pairs = materialize(pairs, "pairs")
    mean = pairs.agg(F.avg("n").alias("m")).scalar()
    return pairs.filter(F.col("n") > mean).select("src", "dst")


@query("j3_edge_costs", f"WITH {PLACES} SELECT src, dst, round(cost, 6) AS cost FROM edge")
def j3(t):
    return lk.edge_costs(places(t), trade_links(t)).select("src", "dst", F.round("cost", 6).alias("cost"))


@query("j4_distances", """
    SELECT p_partkey, round(sqrt((px - p_size)*(px - p_size) + (py - p_retailprice)*(py - p_retailprice)), 6) AS dist
    FROM part, (SELECT arg_max(p_size, (p_retailprice, p_partkey)) AS px, max(p_retailprice) AS py FROM part)""")
def j4(t):
    points = t("part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("x"), F.col("p_retailprice").alias("y"))
    probe = points.agg(F.max_by(F.struct("x", "y"), F.struct("y", "id")).alias("p")).select("p.*")
    return lk.distances(points, probe).select(F.col("id").alias("p_partkey"), F.round("dist", 6).alias("dist"))


_CENTRES = """centres AS (SELECT label AS qid, list(v ORDER BY i) AS vector FROM (
      SELECT label, i, avg(embedding[i]::DOUBLE) AS v FROM (SELECT label, embedding, unnest(range(1, 65)) AS i FROM embeddings)
      GROUP BY ALL) GROUP BY label)"""
_HITS = f"""{_CENTRES},
    scored AS (SELECT qid, vec_id AS id, list_cosine_similarity(embedding::DOUBLE[], vector) AS score FROM embeddings, centres),
    hits AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id)::INT AS rank FROM scored
      QUALIFY rank <= 10)"""


def _hits(t, metric="cosine"):
    """The 10 vectors nearest to the mean vector of each label; there are few labels at any scale."""
    corpus = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    centres = rt.mean_vectors(t("embeddings"), "label", "embedding").withColumnRenamed("label", "qid")
    return rt.top_k(centres, corpus, 10, metric)


@query("j5_top_k_cosine", f"WITH {_HITS} SELECT qid, id, round(score, 6) AS score, rank FROM hits")
def j5(t):
    return _hits(t).withColumn("score", F.round("score", 6))


@query("j5_top_k_l2", f"""WITH {_CENTRES} SELECT qid, vec_id AS id,
      round(list_sum(list_transform(list_zip(embedding::DOUBLE[], vector), lambda p: (p[1]-p[2])*(p[1]-p[2]))), 6) AS score,
      row_number() OVER (PARTITION BY qid ORDER BY list_distance(embedding::DOUBLE[], vector), vec_id)::INT AS rank
    FROM embeddings, centres QUALIFY rank <= 10""")
def j5_l2(t):
    return _hits(t, "l2").withColumn("score", F.round("score", 6))


_INDEX_SQL = """
    WITH probes AS (SELECT vec_id AS qid, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 100 = 0),
    scored AS (SELECT qid, vec_id AS id, {score} AS score FROM embeddings, probes)
    SELECT qid, id, round(score, 6) AS score, row_number() OVER (PARTITION BY qid ORDER BY {order}, id)::INT AS rank
    FROM scored QUALIFY rank <= 10"""


def _index_hits(t, metric):
    """Every row whose id is divisible by 100 against an index of all rows."""
    corpus = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    index = VectorIndex.build(corpus, metric)
    return rt.search(index, corpus.filter("id % 100 = 0").withColumnRenamed("id", "qid"), 10)


@query("j5_index_cosine", _INDEX_SQL.format(score="list_cosine_similarity(embedding::DOUBLE[], q)", order="score DESC"))
def j5_index(t):
    return _index_hits(t, "cosine").withColumn("score", F.round("score", 6))


@query("j5_index_l2", _INDEX_SQL.format(
    score="list_sum(list_transform(list_zip(embedding::DOUBLE[], q), lambda p: (p[1]-p[2])*(p[1]-p[2])))", order="score"))
def j5_index_l2(t):
    return _index_hits(t, "l2").withColumn("score", F.round("score", 6))


_CONTEXT = f"""WITH {_HITS} SELECT qid, count(*) AS n_hits, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context
    FROM hits JOIN documents ON id = doc_id GROUP BY qid"""


def _context(t):
    return rt.attach_context(_hits(t), t("documents").select(F.col("doc_id").alias("id"), "text"))


@query("j6_attach_context", _CONTEXT)
def j6(t):
    return _context(t)


@query("t13_render_rag", f"""
    SELECT qid, chr(10) || 'You are an assistant for question-and-answer sessions about the book "Corpus" by Test Data.' || chr(10)
      || 'Use the following pieces of retrieved context to answer the questions.' || chr(10)
      || 'If you don''t know the answer, you can say "I don''t know".' || chr(10)
      || 'QUESTION: What is label ' || qid || ' about?' || chr(10) || 'CONTEXT: ' || context || chr(10) || 'ANSWER:' || chr(10) AS prompt
    FROM ({_CONTEXT})""")
def t13(t):
    question = F.concat(F.lit("What is label "), F.col("qid").cast("string"), F.lit(" about?"))
    return _context(t).select("qid", tp.render_rag(question, F.col("context"), "Corpus", "Test Data").alias("prompt"))


@query("w6_nearest_three", """
    WITH p AS (SELECT p_partkey AS id, p_size::DOUBLE AS x, p_retailprice AS y, p_brand FROM part),
    f AS (SELECT min(id) AS id FROM p GROUP BY p_brand)
    SELECT a.id AS qid, b.id, round(sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y)), 6) AS dist,
      row_number() OVER (PARTITION BY a.id ORDER BY (a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y), b.id)::INT AS rank
    FROM p a JOIN f ON a.id = f.id JOIN p b ON a.id <> b.id QUALIFY rank <= 3""")
def w6(t):
    points = t("part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("x"), F.col("p_retailprice").alias("y"), "p_brand")
    firsts = points.groupBy("p_brand").agg(F.min_by(F.struct("id", "x", "y"), "id").alias("p")).select("p.*")
    return rt.knn(firsts, points, 3).withColumn("dist", F.round("dist", 6))


@query("j7_fill_from", """
    SELECT l_orderkey, l_linenumber, coalesce(o.disc, nullif(l_discount, 0), o2.price) AS l_discount FROM lineitem
    LEFT JOIN (SELECT s_suppkey, s_acctbal AS disc FROM supplier WHERE s_acctbal < 0) o ON l_suppkey = o.s_suppkey
    LEFT JOIN (SELECT p_partkey, p_retailprice AS price FROM part WHERE p_size < 40) o2 ON l_partkey = o2.p_partkey""")
def j7(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_discount")
    manual = t("supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_acctbal").alias("l_discount"))
    second = t("part").filter("p_size < 40").select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("l_discount"))
    filled = lk.fill_from(rows, manual, ["l_suppkey"], ["l_discount"])
    return lk.fill_missing(filled, second, ["l_partkey"], ["l_discount"]).select("l_orderkey", "l_linenumber", "l_discount")


@query("j8_aligned_concat", """
    SELECT event_id, event_type, (props->>'$.k')::INT AS k FROM events""")
def j8(t):
    parsed = F.from_json("props", "k int").alias("p")
    return rw.flatten_struct(t("events").select("event_id", "event_type", parsed), "p")


@query("j9_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def j9(t):
    big = t("orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return rw.within(t("customer").select("c_custkey", "c_name"), big, ["c_custkey"])


@query("j9_anti", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def j9_anti(t):
    used = t("lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return rw.minus(t("part").select("p_partkey", "p_name"), used, ["p_partkey"])


@query("j10_pairing", """
    SELECT a.conv_id, a.turn, a.text AS prediction, b.text AS reference FROM conversations a
    JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def j10(t):
    turns = t("conversations")
    pred = turns.select("conv_id", "turn", F.col("text").alias("prediction"))
    ref = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reference"))
    return lk.pair(pred, ref, ["conv_id", "turn"])


def _reign_lines(t):
    """One line per customer and priority: the order years, then the name in parentheses."""
    years = t("orders").groupBy("o_custkey", "o_orderpriority").agg(F.array_sort(F.collect_set(F.year("o_orderdate"))).alias("y"))
    return years.select(F.concat(F.lit(" "), F.array_join(F.transform("y", lambda v: v.cast("string")), ", "), F.lit(" (Customer "),
                                 F.col("o_custkey").cast("string"), F.lit(")")).alias("line"))


@query("t26_parse_reigns", """
    SELECT 'Customer ' || o_custkey AS alias, array_to_string(list_sort(list(DISTINCT year(o_orderdate)::VARCHAR)), ' ') AS reign
    FROM orders GROUP BY o_custkey""")
def t26(t):
    reigns = lk.parse_reigns(_reign_lines(t), "line")
    return st.union_sets(reigns, "alias", "year", "reign").withColumn("reign", F.array_join("reign", " "))
