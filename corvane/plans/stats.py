"""Aggregate and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import arrays as ar
from corvane.operators import chunks as ck
from corvane.operators import rouge as rg
from corvane.operators import stats as st
from corvane.operators import tokens as tk
from corvane.plans import query
from corvane.plans.rows import BOARD, board, sql_map
from corvane.scale import spread
from corvane.plans.text import _ENCODED, _PAIRS, _lookback, _turn_pairs, encoded


@query("a1_row_counts", """
    SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'documents', count(*) FROM documents""")
def a1(t):
    counts = [t(n).agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n in ("orders", "lineitem", "documents")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("a2_chunk_stats", f"""
    SELECT doc_id, count(*) AS n_chunks, round(avg(length(chunk)), 9) AS mean_length
    FROM ({_lookback(1024, 100, 512)}) GROUP BY doc_id""")
def a2(t):
    stats = st.chunk_stats(ck.chunk_lookback(t.spread("documents", "doc_id"), 1024, 100))
    return stats.withColumn("mean_length", F.round("mean_length", 9))


@query("a2_size_report", f"""
    SELECT count(*) AS n_rows, round(avg(length(chunk)), 9) AS mean_length
    FROM ({_lookback(1024, 100, 512)})""")
def a2_total(t):
    report = st.size_report(ck.chunk_lookback(t.spread("documents", "doc_id"), 1024, 100))
    return report.withColumn("mean_length", F.round("mean_length", 9))


@query("a3_value_counts", """
    SELECT event_type, count(*) / (SELECT count(*) FROM events) AS share FROM events GROUP BY event_type""")
def a3(t):
    return st.value_counts(t("events"), "event_type", normalize=True)


@query("a4_centroid", """
    SELECT round(avg(s_acctbal), 9) AS y, round(avg(s_nationkey), 9) AS x FROM supplier""")
def a4(t):
    c = st.centroid(t("supplier"), "s_nationkey", "s_acctbal")
    return c.select(F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


@query("a5_union_sets", """
    SELECT o_custkey, array_to_string(list_sort(list(DISTINCT year(o_orderdate)::INT)), ' ') AS reign
    FROM orders GROUP BY o_custkey""")
def a5(t):
    sets = st.union_sets(t("orders").withColumn("y", F.year("o_orderdate")), "o_custkey", "y", "reign")
    return sets.withColumn("reign", F.array_join("reign", " "))


@query("a6_batches", """
    SELECT o_orderkey, r // 2 AS batch, r // 32 AS step
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders)""")
def a6(t):
    return tk.assign_batches(t("orders").select("o_orderkey"), ["o_orderkey"], 2, 16)


@query("a6_batch_shape", """
    SELECT r // 32 AS step, count(*) AS n_rows, count(DISTINCT r // 2) AS n_batches
    FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders) GROUP BY ALL""")
def a6_shape(t):
    placed = tk.assign_batches(t("orders").select("o_orderkey"), ["o_orderkey"], 2, 16)
    return placed.groupBy("step").agg(F.count("*").alias("n_rows"), F.countDistinct("batch").alias("n_batches"))


@query("a7_memberships", """
    SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS line FROM events GROUP BY user_id""")
def a7(t):
    return st.union_sets(t("events"), "user_id", "event_type", "line").withColumn("line", F.array_join("line", ","))


_SCORED = """(SELECT l.doc_id, l.quality AS y, (d.n_chars > 600)::INT AS yhat, d.n_chars AS score
              FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _scored(t):
    docs = t("documents").select("doc_id", (F.col("n_chars") > 600).cast("int").alias("yhat"), F.col("n_chars").alias("score"))
    return t("labels").select("doc_id", F.col("quality").alias("y")).join(docs, "doc_id")


_CLASS = f"""
    s AS (SELECT c, sum(((y = c) AND (yhat = c))::INT)::DOUBLE AS hit, sum((yhat = c)::INT)::DOUBLE AS predicted,
                 sum((y = c)::INT)::BIGINT AS support
          FROM {_SCORED}, (SELECT DISTINCT y AS c FROM {_SCORED} UNION SELECT DISTINCT yhat FROM {_SCORED}) GROUP BY c),
    p AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS precision,
                 CASE WHEN support = 0 THEN 0 ELSE hit / support END AS recall FROM s),
    f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2*precision*recall/(precision + recall) END AS f1 FROM p)"""


@query("a8_classification_report", f"""
    WITH {_CLASS}
    SELECT label, round(precision::DOUBLE, 6) AS precision, round(recall::DOUBLE, 6) AS recall, round(f1::DOUBLE, 6) AS f1, support FROM (
      SELECT c::VARCHAR AS label, precision, recall, f1, support FROM f UNION ALL
      SELECT 'accuracy', sum(hit)/sum(support), sum(hit)/sum(support), sum(hit)/sum(support), sum(support)::BIGINT FROM f UNION ALL
      SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM f UNION ALL
      SELECT 'weighted avg', sum(precision*support)/sum(support), sum(recall*support)/sum(support),
             sum(f1*support)/sum(support), sum(support)::BIGINT FROM f)""")
def a8(t):
    report = st.classification_report(_scored(t), "y", "yhat")
    return report.withColumns({n: F.round(n, 6) for n in ("precision", "recall", "f1")})


@query("a9_confusion_matrix", f"""
    SELECT y, sum((yhat = 0)::INT)::BIGINT AS pred_0, sum((yhat = 1)::INT)::BIGINT AS pred_1,
      sum((yhat NOT IN (0, 1))::INT)::BIGINT AS pred_other FROM {_SCORED} GROUP BY y""")
def a9(t):
    return st.confusion_matrix(_scored(t), "y", "yhat", [0, 1])


@query("a9_fbeta", f"""
    WITH {_CLASS} SELECT c, round(CASE WHEN 4*precision + recall = 0 THEN 0 ELSE 5*precision*recall/(4*precision + recall)
      END::DOUBLE, 6) AS f2 FROM f""")
def a9_fbeta(t):
    return st.class_scores(_scored(t), "y", "yhat", beta=2.0).select("c", F.round("f1", 6).alias("f2"))


@query("a9_balanced_accuracy", f"WITH {_CLASS} SELECT round(avg(recall), 6) AS balanced_accuracy FROM f WHERE support > 0")
def a9_balanced(t):
    return st.balanced_accuracy(_scored(t), "y", "yhat").select(F.round("balanced_accuracy", 6).alias("balanced_accuracy"))


@query("a9_auc", f"""
    WITH r AS (SELECT y, score, (SELECT count(*) FROM {_SCORED} b WHERE b.y = 0 AND b.score < a.score) AS below,
                      (SELECT count(*) FROM {_SCORED} b WHERE b.y = 0 AND b.score = a.score) AS same FROM {_SCORED} a)
    SELECT round(sum(below + same / 2.0::DOUBLE) FILTER (y = 1) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 6) AS auc FROM r""")
def a9_auc(t):
    return st.auc(_scored(t), "y", "score").select(F.round("auc", 6).alias("auc"))


_TOK = "list_filter(regexp_split_to_array(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"


def _rouge_sql(n: int, rounded: bool = True) -> str:
    gram = "w[i]" if n == 1 else "w[i] || ' ' || w[i + 1]"
    score = "coalesce(CASE WHEN hit > 0 THEN 100 * 2 * (hit/nq) * (hit/na) / (hit/nq + hit/na) END, 0)::DOUBLE"
    score = f"round({score}, 6)" if rounded else score
    return f"""
    WITH base AS (SELECT conv_id, turn, {_TOK.format('question')} AS q, {_TOK.format('answer')} AS a FROM {_PAIRS}),
    g AS (SELECT conv_id, turn, gram, sum((side = 'q')::INT) AS nq, sum((side = 'a')::INT) AS na FROM (
            SELECT conv_id, turn, 'q' AS side, {gram} AS gram FROM (
              SELECT conv_id, turn, q AS w, unnest(range(1, len(q) - {n} + 2)) AS i FROM base) UNION ALL
            SELECT conv_id, turn, 'a', {gram} FROM (
              SELECT conv_id, turn, a AS w, unnest(range(1, len(a) - {n} + 2)) AS i FROM base)) GROUP BY ALL),
    s AS (SELECT conv_id, turn, sum(least(nq, na))::DOUBLE AS hit, sum(nq)::DOUBLE AS nq, sum(na)::DOUBLE AS na FROM g GROUP BY ALL)
    SELECT b.conv_id, b.turn, {score} AS score
    FROM base b LEFT JOIN s ON s.conv_id = b.conv_id AND s.turn = b.turn"""


def _pairs(t):
    return spread(_turn_pairs(t), "conv_id", "turn").select("conv_id", "turn", F.col("question").alias("prediction"), F.col("answer").alias("reference"))


@query("a11_rouge_1", _rouge_sql(1))
def a11(t):
    out = rg.rouge_n(_pairs(t), 1, ["conv_id", "turn"])
    return out.select("conv_id", "turn", F.round("rouge1", 6).alias("score"))


@query("a11_rouge_2", _rouge_sql(2))
def a11_two(t):
    out = rg.rouge_n(_pairs(t), 2, ["conv_id", "turn"])
    return out.select("conv_id", "turn", F.round("rouge2", 6).alias("score"))


def _lcs_sql(rounded: bool = True) -> str:
    score = "(CASE WHEN lcs = 0 THEN 0 ELSE 100 * 2 * (lcs/m) * (lcs/n) / (lcs/m + lcs/n) END)::DOUBLE"
    score = f"round({score}, 6)" if rounded else score
    return f"""
    WITH base AS (SELECT conv_id, turn, {_TOK.format('question')} AS q, {_TOK.format('answer')} AS a FROM {_PAIRS}),
    l AS (SELECT conv_id, turn, len(q) AS m, len(a) AS n, CASE WHEN len(q) = 0 OR len(a) = 0 THEN 0 ELSE
            list_last(list_reduce(q, lambda acc, x:
              list_reduce(list_transform(range(1, len(a) + 1), lambda j: [j, (a[j] = x)::INT]),
                lambda row, jm: list_append(row, greatest(row[jm[1]], acc[jm[1] + 1], acc[jm[1]] + jm[2])), [0::BIGINT]),
              list_transform(range(0, len(a) + 1), lambda j: 0::BIGINT))) END AS lcs FROM base)
    SELECT conv_id, turn, {score} AS score FROM l"""


@query("a12_rouge_l", _lcs_sql())
def a12(t):
    return rg.rouge_l(_pairs(t), ["conv_id", "turn"], variants=["rougeL"]).select("conv_id", "turn", F.round("rougeL", 6).alias("score"))


@query("a12_rouge_lsum")
def a12_sum(t):
    return rg.rouge_l(_pairs(t), ["conv_id", "turn"], variants=["rougeLsum"]).select("conv_id", "turn", F.round("rougeLsum", 6).alias("score"))


def _one_line(pairs):
    """Texts with their lines joined: there the per-line score must equal that of whole texts."""
    return pairs.withColumns({c: F.translate(c, "\n", " ") for c in ("prediction", "reference")})


@query("a12_rouge_lsum_one_line", _lcs_sql())
def a12_line(t):
    out = rg.rouge_l(_one_line(_pairs(t)), ["conv_id", "turn"], variants=["rougeLsum"])
    return out.select("conv_id", "turn", F.round("rougeLsum", 6).alias("score"))


@query("a10_rouge_means", f"""
    SELECT round(avg(r1.score), 6) AS rouge1, round(avg(r2.score), 6) AS rouge2, round(avg(l.score), 6) AS rougeL, round(avg(l.score), 6) AS rougeLsum
    FROM ({_rouge_sql(1, False)}) r1 JOIN ({_rouge_sql(2, False)}) r2 ON r1.conv_id = r2.conv_id AND r1.turn = r2.turn
    JOIN ({_lcs_sql(False)}) l ON r1.conv_id = l.conv_id AND r1.turn = l.turn""")
def a10_four(t):
    """All four means over texts of one line, where SQL can express the fourth."""
    means = st.rouge_means(_one_line(_pairs(t)), ["conv_id", "turn"])
    return means.select(*[F.round(n, 6).alias(n) for n in means.columns])


@query("a10_metric_means", f"""
    SELECT round(avg(r1.score), 6) AS rouge1, round(avg(r2.score), 6) AS rouge2
    FROM ({_rouge_sql(1, False)}) r1 JOIN ({_rouge_sql(2, False)}) r2 ON r1.conv_id = r2.conv_id AND r1.turn = r2.turn""")
def a10(t):
    both = rg.rouge(_pairs(t), ["conv_id", "turn"], ["rouge1", "rouge2"])
    means = st.metric_means(both, ["rouge1", "rouge2"])
    return means.select(*[F.round(n, 6).alias(n) for n in ("rouge1", "rouge2")])


_WEIGHTS = {**ar.MATERIAL, **{k.lower(): -v for k, v in ar.MATERIAL.items()}, ".": 0}
_SCORE = f"list_sum(list_transform({BOARD}, lambda x: {sql_map(_WEIGHTS)}[x]))"


@query("a13_material_score", f"SELECT vec_id, {_SCORE}::INT AS score FROM embeddings")
def a13(t):
    return t("embeddings").select("vec_id", ar.material_score(board()).alias("score"))


_PIECES = {"click": "P", "view": "p", "purchase": "Q", "signup": "r", "error": "k"}


@query("a13_material_by_user", f"""
    SELECT user_id, sum({sql_map({k: _WEIGHTS[v] for k, v in _PIECES.items()})}[event_type])::BIGINT AS score
    FROM events GROUP BY user_id""")
def a13_user(t):
    symbol = F.try_element_at(ar.literal_map(_PIECES), F.col("event_type"))
    return st.material_by(t("events"), "user_id", ar.symbol_weight(symbol))


@query("a14_score_with_mobility", f"""
    SELECT vec_id, round({_SCORE} + (label % 2 = 0)::INT * 0.1::DOUBLE * len(list_filter({BOARD}, lambda x: x = '.')), 4) AS score
    FROM embeddings""")
def a14(t):
    state = t("embeddings").select("vec_id", "label", board().alias("s"))
    score = ar.score_with_mobility(ar.material_score(F.col("s")), F.col("label") % 2 == 0, ar.count_symbol(F.col("s"), "."))
    return state.select("vec_id", F.round(score, 4).alias("score"))


@query("a15_last_metric", """
    SELECT coalesce(arg_max(event_type || ' ' || props, event_id), 'No metrics available') AS last_metric FROM events""")
def a15(t):
    return st.last_metric(t("events"), "event_id", F.concat("event_type", F.lit(" "), "props"))


@query("a16_latest_version", """
    SELECT c_nationkey, arg_max(c_name, string_split(c_name, '#')[2]::BIGINT) AS latest FROM customer GROUP BY c_nationkey""")
def a16(t):
    return st.latest_version(t("customer"), "c_name", "Customer#", ["c_nationkey"])


@query("a17_last_message", "SELECT conv_id, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id")
def a17(t):
    return st.last_entry(t("conversations"), ["turn"], ["role", "text"], ["conv_id"])


@query("a18_profile", f"""
    WITH {_ENCODED} SELECT count(*) AS n_rows, 512 AS min_len, 512 AS max_len,
      round(avg((len(ids) < 512 OR list_contains(ids, 2))::INT), 6) AS padded_share FROM ids""")
def a18(t):
    return st.profile(encoded(t, cut=True), "input_ids", tk.EOS_ID).withColumn(
        "padded_share", F.round("padded_share", 6))


@query("a19_minmax", """
    SELECT p_partkey, p_retailprice AS w, round((p_retailprice - (SELECT min(p_retailprice) FROM part)) /
      ((SELECT max(p_retailprice) - min(p_retailprice) FROM part)), 4) AS scaled FROM part
    UNION ALL SELECT p_partkey, -p_retailprice, 0.0 - round((p_retailprice - (SELECT min(p_retailprice) FROM part)) /
      ((SELECT max(p_retailprice) - min(p_retailprice) FROM part)), 4) FROM part""")
def a19(t):
    part = t("part").select("p_partkey", F.col("p_retailprice").alias("w"))
    return st.mirrored(st.minmax(part, "w"), "w", "scaled")
