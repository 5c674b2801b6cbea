"""Projection, filter, set, array and function queries (P, U, F, D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import arrays as ar
from corvane.functions import text as tx
from corvane.operators import chunks as ck
from corvane.operators import rows as rw
from corvane.operators import stats as st
from corvane.plans import query

# A 64-square board read off the 64 embedding values: (upper bound, symbol), then the rest.
_CUTS = [(-0.2, "k"), (-0.15, "q"), (-0.1, "r"), (-0.06, "b"), (-0.03, "p"), (0.03, "."),
         (0.06, "P"), (0.1, "N"), (0.15, "R"), (0.2, "Q")]


def board(col="embedding"):
    def symbol(x):
        out = F.when(x.cast("double") < _CUTS[0][0], _CUTS[0][1])
        for cut, sym in _CUTS[1:]:
            out = out.when(x.cast("double") < cut, sym)
        return out.otherwise("K")
    return F.transform(col, symbol)


BOARD = ("list_transform(embedding, lambda x: CASE "
         + " ".join(f"WHEN x::DOUBLE < ({c})::DOUBLE THEN '{s}'" for c, s in _CUTS) + " ELSE 'K' END)")


def sql_map(table: dict) -> str:
    keys = ", ".join(repr(k) for k in table)
    return f"MAP([{keys}], [{', '.join(repr(v) for v in table.values())}])"


@query("p1_add_columns", """
    SELECT doc_id, upper(lang) AS lang, n_chars, n_chars // 2 AS half, length(text) = n_chars AS exact FROM documents""")
def p1(t):
    df = t("documents").withColumns({"lang": F.upper("lang"), "half": F.expr("n_chars div 2"),
                                     "exact": F.length("text") == F.col("n_chars")})
    return df.select("doc_id", "lang", "n_chars", "half", "exact")


@query("p2_flatten_struct", """
    SELECT event_id, user_id, event_type AS moved_piece, (props->>'$.k')::INT AS moved_from,
           99 - (props->>'$.k')::INT AS moved_to FROM events""")
def p2(t):
    k = F.get_json_object("props", "$.k").cast("int")
    move = F.struct(F.col("event_type").alias("moved_piece"), k.alias("moved_from"), (99 - k).alias("moved_to"))
    return rw.flatten_struct(t("events").select("event_id", "user_id", move.alias("move")), "move")


@query("p3_reorder", """
    SELECT 'carlsen0x000' AS id, user_id AS player, event_id AS turn_count, event_type AS state FROM events""")
def p3(t):
    df = t("events").withColumn("id", F.lit("carlsen0x000"))
    return df.select("id", F.col("user_id").alias("player"), F.col("event_id").alias("turn_count"),
                     F.col("event_type").alias("state"))


@query("p4_features", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def p4_x(t):
    return rw.xy(t("part"), ["p_type", "p_retailprice"])[0]


@query("p4_targets", "SELECT p_type, p_retailprice FROM part")
def p4_y(t):
    return rw.xy(t("part"), ["p_type", "p_retailprice"])[1]


@query("p5_widen", "SELECT vec_id, label, " + ", ".join(f'embedding[{i + 1}] AS "{i}"' for i in range(64))
       + " FROM embeddings")
def p5(t):
    return rw.widen_array(t("embeddings"), "embedding", 64)


@query("p5_narrow", "SELECT vec_id, len(embedding)::INT AS n, list_sum(list_transform(embedding, "
       "lambda x: floor(x::DOUBLE * 10000)::INT))::BIGINT AS checksum FROM embeddings")
def p5_back(t):
    wide = rw.widen_array(t("embeddings"), "embedding", 64)
    back = rw.narrow_array(wide, [str(i) for i in range(64)], "embedding")
    cells = F.transform("embedding", lambda x: F.floor(x.cast("double") * 10000))
    return back.select("vec_id", F.size("embedding").alias("n"),
                       F.aggregate(cells, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("checksum"))


@query("p6_any_contains", """
    SELECT doc_id, lang FROM documents WHERE contains(text, 'eau') OR contains(text, 'nder') OR contains(text, 'ß')""")
def p6(t):
    return rw.filter_any_contains(t("documents"), "text", ["eau", "nder", "ß"]).select("doc_id", "lang")


@query("p6_name_contains", "SELECT c_custkey, c_name FROM customer WHERE contains(c_name, '7') OR contains(c_name, '00012')")
def p6_name(t):
    return rw.filter_any_contains(t("customer"), "c_name", ["7", "00012"]).select("c_custkey", "c_name")


@query("p7_not_null", """
    SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL""")
def p7(t):
    joined = t("documents").select("doc_id").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    return joined.dropna(subset=["quality"])


@query("p8_for_actor", "SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'")
def p8(t):
    return rw.for_actor(t("conversations"), "assistant").select("conv_id", "turn", "text")


@query("p8_turn_parity", "SELECT conv_id, turn, role FROM conversations WHERE turn % 2 = 1")
def p8_parity(t):
    turns = t("conversations").withColumn("side", F.when(F.col("turn") % 2 == 1, "B").otherwise("W"))
    return rw.for_actor(turns, "B", "side").select("conv_id", "turn", "role")


@query("p9_min_size", """
    SELECT doc_id, count(*) AS n FROM (
      SELECT doc_id, substr(text, i*300 + 1, 300) AS c
      FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 299)//300)) AS i FROM documents))
    WHERE length(c) >= 150 GROUP BY doc_id""")
def p9(t):
    chunks = ck.chunk_stride(t.spread("documents", "doc_id"), 300, 0)
    return chunks.groupBy("doc_id").agg(F.count("*").alias("n"))


@query("p10_empty_sources", "SELECT doc_id, source, n_chars FROM documents WHERE length(text) < 512")
def p10(t):
    docs = t("documents")
    chunks = rw.require_rows(ck.chunk_lookback(docs, 1024, 100))
    return rw.empty_sources(docs.select("doc_id", "source", "n_chars"), chunks, "doc_id")


_TYPES = {"click": "azul", "view": "verde", "purchase": "vermelha", "signup": "amarela", "error": "lilas"}
_DAYS = """(SELECT user_id, ts::DATE AS day, list_sort(list(DISTINCT event_type)) AS types FROM events GROUP BY ALL)"""


@query("p11_colour", f"""
    SELECT user_id, day::VARCHAR AS day, CASE WHEN len(types) = 1 THEN
       {sql_map({k: rw.LINE_COLOURS[v] for k, v in _TYPES.items()})}[types[1]] ELSE 'black' END AS cor FROM {_DAYS}""")
def p11(t):
    lines = t("events").select("user_id", F.to_date("ts").alias("day"),
                               F.try_element_at(ar.literal_map(_TYPES), F.col("event_type")).alias("line"))
    sets = lines.groupBy("user_id", "day").agg(F.collect_set("line").alias("line"))
    return sets.select("user_id", F.col("day").cast("string").alias("day"), rw.colour(F.col("line")).alias("cor"))


_SIDES = """(SELECT doc_id, upper(left(source, 1)) || substr(source, 2) || ', First' AS white,
    lang || ' Second' || (n_chars % 7) || ', X' AS black FROM documents)"""


def _sides(t):
    white = F.concat(F.upper(F.left("source", F.lit(1))), F.expr("substr(source, 2)"), F.lit(", First"))
    black = F.concat("lang", F.lit(" Second"), (F.col("n_chars") % 7).cast("string"), F.lit(", X"))
    return t("documents").select("doc_id", white.alias("white"), black.alias("black"))


@query("p12_resolve_side", f"""
    SELECT doc_id, CASE WHEN contains(lower(white), 'src1') THEN 'W' ELSE 'B' END AS side,
      replace(lower(string_split(CASE WHEN contains(lower(white), 'src1') THEN black ELSE white END, ',')[1]), ' ', '_') AS opponent
    FROM {_SIDES} WHERE contains(lower(white), 'src1') OR contains(lower(black), 'src1')""")
def p12(t):
    return rw.split_inconsistent(rw.resolve_side(_sides(t), "Src1"))[0].select("doc_id", "side", "opponent")


@query("p12_inconsistent", f"""
    SELECT doc_id, white, black FROM {_SIDES}
    WHERE NOT contains(lower(white), 'second3') AND NOT contains(lower(black), 'second3')""")
def p12_rest(t):
    return rw.split_inconsistent(rw.resolve_side(_sides(t), "Second3"))[1].select("doc_id", "white", "black")


@query("p13_missing", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount = 0")
def p13(t):
    return rw.missing(t("lineitem"), "l_discount").select("l_orderkey", "l_linenumber")


@query("u1_append", """
    SELECT 'c' AS kind, c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL
    SELECT 's', s_suppkey, s_acctbal FROM supplier""")
def u1(t):
    c = t("customer").select(F.lit("c").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    s = t("supplier").select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return rw.append(c, s)


@query("u2_union_arrays", """
    SELECT o_orderkey, array_to_string(list_sort(list_distinct([o_orderstatus, left(o_orderpriority, 1), 'F', '2'])), ' ') AS tags
    FROM orders""")
def u2(t):
    a = F.array("o_orderstatus", F.left("o_orderpriority", F.lit(1)))
    return t("orders").select("o_orderkey", F.array_join(
        rw.union_arrays(a, F.array(F.lit("F"), F.lit("2"))), " ").alias("tags"))


@query("u3_minus", """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def u3(t):
    seen = t("orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return rw.minus(t("customer").select("c_custkey", "c_name"), seen, ["c_custkey"])


@query("f1_euclid", """
    SELECT l_orderkey, l_linenumber, round(sqrt((l_quantity - l_discount*100)*(l_quantity - l_discount*100)
      + (l_tax*100 - l_linenumber)*(l_tax*100 - l_linenumber)), 6) AS dist FROM lineitem""")
def f1(t):
    q, d = F.col("l_quantity"), F.col("l_discount") * 100
    x, n = F.col("l_tax") * 100, F.col("l_linenumber")
    return t("lineitem").select("l_orderkey", "l_linenumber", F.round(ar.euclid(q, x, d, n), 6).alias("dist"))


@query("f2_ceil_to_tens", "SELECT p_partkey, ceil(p_retailprice / 10.0)::INT * 10 AS tens FROM part")
def f2(t):
    return t("part").select("p_partkey", ar.ceil_to_tens(F.col("p_retailprice")).alias("tens"))


_CELLS = "list_transform(embedding, lambda x: floor(x::DOUBLE * 10000)::BIGINT)"
_GRID = f"list_transform(range(0, 8), lambda r: ({_CELLS})[r*8 + 1 : r*8 + 8])"


def _grid():
    return ar.reshape(F.transform("embedding", lambda x: F.floor(x.cast("double") * 10000)), 8, 8)


def _flat(matrix):
    return F.array_join(F.flatten(matrix), " ")


@query("f3_reshape", f"""
    SELECT vec_id, r::INT AS board_row, array_to_string(g[r + 1], ' ') AS squares
    FROM (SELECT vec_id, {_GRID} AS g, unnest(range(0, 8)) AS r FROM embeddings)""")
def f3(t):
    rows = t("embeddings").select("vec_id", F.posexplode(_grid()).alias("board_row", "s"))
    return rows.select("vec_id", "board_row", F.array_join("s", " ").alias("squares"))


@query("f4_flips", f"""
    SELECT vec_id, array_to_string(flatten(list_reverse(g)), ' ') AS white_view,
           array_to_string(flatten(list_transform(g, lambda r: list_reverse(r))), ' ') AS black_view
    FROM (SELECT vec_id, {_GRID} AS g FROM embeddings)""")
def f4(t):
    return t("embeddings").select("vec_id", _flat(ar.flip_rows(_grid())).alias("white_view"),
                                  _flat(ar.flip_cols(_grid())).alias("black_view"))


@query("f5_square_xy", """
    SELECT l_orderkey, l_linenumber, (i % 8)::INT AS white_x, (7 - i // 8)::INT AS white_y,
           (7 - i % 8)::INT AS black_x, (i // 8)::INT AS black_y
    FROM (SELECT *, l_partkey % 64 AS i FROM lineitem)""")
def f5(t):
    i = F.col("l_partkey") % 64
    w, b = ar.square_xy(i, "W"), ar.square_xy(i, "B")
    return t("lineitem").select("l_orderkey", "l_linenumber", w[0].alias("white_x"), w[1].alias("white_y"),
                                b[0].alias("black_x"), b[1].alias("black_y"))


@query("f6_delta", """
    SELECT l_orderkey, l_linenumber, ((v % 8) - (u % 8))::INT AS dx, ((7 - v // 8) - (7 - u // 8))::INT AS dy
    FROM (SELECT *, l_partkey % 64 AS u, l_suppkey % 64 AS v FROM lineitem)""")
def f6(t):
    d = ar.delta(ar.square_xy(F.col("l_partkey") % 64, "W"), ar.square_xy(F.col("l_suppkey") % 64, "W"))
    return t("lineitem").select("l_orderkey", "l_linenumber", d[0].alias("dx"), d[1].alias("dy"))


_SCALED = ar.scaled_weights()


@query("f7_map_matrix", f"""
    SELECT vec_id, round(list_sum(list_transform(flatten(g), lambda x: {sql_map(_SCALED)}[x]))::DOUBLE, 4) AS total,
           list_max(list_transform(g[1], lambda x: {sql_map(_SCALED)}[x]))::DOUBLE AS top FROM (
      SELECT vec_id, list_transform(range(0, 8), lambda r: (s)[r*8 + 1 : r*8 + 8]) AS g FROM (
        SELECT vec_id, list_transform({BOARD}, lambda x: {sql_map(ar.PIECE_WEIGHTS)}[x]) AS s FROM embeddings))""")
def f7(t):
    state = ar.encode_symbols(board(), ar.PIECE_WEIGHTS)
    scaled = t("embeddings").select("vec_id", ar.map_matrix(ar.reshape(state, 8, 8), _SCALED).alias("m"))
    total = F.aggregate(F.flatten("m"), F.lit(0.0), lambda a, x: a + x)
    return scaled.select("vec_id", F.round(total, 4).alias("total"), F.array_max(F.col("m")[0]).alias("top"))


@query("f8_curve", """
    SELECT event_id, round(2.0::DOUBLE * exp(1.0::DOUBLE / (abs(value) + 1.0)) * sin(0.1::DOUBLE * value * value), 6) AS y
    FROM events""")
def f8(t):
    return t("events").select("event_id", F.round(ar.curve(F.col("value")), 6).alias("y"))


@query("f9_step_size", """
    SELECT o_orderkey, round(1.0::DOUBLE / sqrt(o_orderkey + 1), 9) AS step,
           round(50.0::DOUBLE / (50.0::DOUBLE + 1.0::DOUBLE / sqrt(o_orderkey + 1)), 9) AS alpha FROM orders""")
def f9(t):
    step = ar.step_size(F.col("o_orderkey") + 1)
    return t("orders").select("o_orderkey", F.round(step, 9).alias("step"), F.round(ar.rate(step), 9).alias("alpha"))


@query("f10_count_symbol", f"""
    SELECT vec_id, len(list_filter(s, lambda x: x = 'K'))::INT AS kings, len(list_filter(s, lambda x: x = '.'))::INT AS free
    FROM (SELECT vec_id, {BOARD} AS s FROM embeddings)""")
def f10(t):
    state = t("embeddings").select("vec_id", board().alias("s"))
    return state.select("vec_id", ar.count_symbol(F.col("s"), "K").alias("kings"),
                        ar.count_symbol(F.col("s"), ".").alias("free"))


@query("f11_slices", """
    SELECT doc_id, left(text, 100) AS head, string_split(text, ' ')[-1] AS last_word,
           array_to_string(string_split(text, ' ')[1:5], ' ') AS first_words FROM documents""")
def f11(t):
    items = F.split("text", " ")
    return t("documents").select("doc_id", tx.head_chars(F.col("text"), 100).alias("head"),
                                 F.element_at(items, -1).alias("last_word"),
                                 F.array_join(F.slice(items, 1, 5), " ").alias("first_words"))


@query("d1_row_function", "SELECT conv_id, turn, '[' || role || '] ' || text AS text FROM conversations")
def d1(t):
    df = t("conversations").select("conv_id", "turn", "role", "text")
    return rw.with_fn(df, "text", F.concat(F.lit("["), "role", F.lit("] "), "text")).drop("role")


@query("d2_map_batches", "SELECT doc_id, length(text) AS n, length(regexp_replace(text, '[^aeiou]', '', 'g')) AS vowels FROM documents")
def d2(t):
    def describe(pdf):
        return pdf[["doc_id"]].assign(n=pdf["text"].str.len(), vowels=pdf["text"].str.count("[aeiou]"))
    return rw.map_batches(t("documents").select("doc_id", "text"), describe, "doc_id long, n long, vowels long")


@query("d3_apply_map", f"SELECT event_id, {sql_map(_TYPES)}[event_type] AS line FROM events")
def d3(t):
    return rw.apply_map(t("events"), "event_type", _TYPES, "line").select("event_id", "line")


@query("d4_explode_records", """
    SELECT c_custkey, 'name' AS field, c_name AS content FROM customer UNION ALL
    SELECT c_custkey, 'segment', c_mktsegment FROM customer""")
def d4(t):
    records = F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).alias("content"))
                        for f, c in (("name", "c_name"), ("segment", "c_mktsegment"))])
    return rw.explode_records(t("customer"), records, ["c_custkey"])


@query("d5_features", """
    SELECT event_id, event_type || '|' || ((props->>'$.k')::INT // 20) AS feature, 1.0::DOUBLE AS value FROM events""")
def d5(t):
    k = F.get_json_object("props", "$.k").cast("int")
    df = t("events").select("event_id", F.col("event_type").alias("s"), F.floor(k / 20).cast("string").alias("a"))
    return rw.with_features(df, rw.identity_features).select("event_id", "feature", "value")


@query("d6_tool_function", f"""
    SELECT conv_id, turn, 'This string has ' || len(list_filter(regexp_split_to_array(text, '{tx.SPACE}+'),
           lambda w: w <> '')) || ' tokens.' AS message FROM conversations""")
def d6(t):
    rw.register_tools(t.spark)
    return t("conversations").select("conv_id", "turn", F.expr("tokens_from_string(text)").alias("message"))
