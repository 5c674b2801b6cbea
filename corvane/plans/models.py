"""Model queries (M1, M2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import arrays as ar
from corvane.functions import text as tx
from corvane.operators import models as md
from corvane.operators import rows as rw
from corvane.operators import splits as sp
from corvane.operators import stats as st
from corvane.plans import query
from corvane.plans.rows import board
from corvane.scale import materialize


@query("m1_gbt_report")
def m1(t):
    text = F.col("text")
    docs = t.spread("documents", "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("x0"), tx.token_count(text).cast("double").alias("x1"),
        F.size(F.split(text, "\n")).cast("double").alias("x2"), F.length(F.regexp_replace(text, "[^,.]", "")).cast("double").alias("x3"))
    data = t("labels").select("doc_id", F.col("quality").alias("y")).join(docs, "doc_id")
    data = materialize(data, "features")
    train, test = sp.split(data, 0.2, 33, ["doc_id"])
    out = md.fit_gbt(train, test, ["x0", "x1", "x2", "x3"])
    return st.classification_report(out, "y", "yhat")


@query("m2_action_model")
def m2(t):
    state = ar.encode_symbols(board(), ar.PIECE_CODES)
    values = F.col("embedding")
    rows = t("embeddings").select(
        "vec_id", state.alias("state"),
        (F.array_position(values, F.array_max(values)) - 1).cast("int").alias("moved_from"),
        (F.array_position(values, F.array_min(values)) - 1).cast("int").alias("moved_to"))
    rows = rows.withColumn("moved_piece", F.get("state", F.col("moved_from")))
    wide = rw.widen_array(rows, "state", 64)
    train, val = sp.tail_split(wide, 0.3, "vec_id")
    return md.fit_action(train, val, [str(i) for i in range(64)]).select(
        "vec_id", *[F.round(f"pred_{c}", 4).alias(f"pred_{c}") for c in ("moved_piece", "moved_from", "moved_to")])
