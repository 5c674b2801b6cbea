"""Streaming queries (ST1-ST3), run over the given tables until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.plans import query
from corvane.plans.sequences import RUNNING, TRANSITIONS
from corvane.scale import scratch_path
from corvane.streaming import state as ss

#: Bytes of files in a micro-batch. State puts a key's rows in order, so the limit chooses no result.
BATCH_BYTES = 2 ** 30


def _stream(t, name):
    """The files of the table, one or many, as a stream of bounded micro-batches."""
    either = f"{t.sf_dir.rstrip('/')}/{{{name}}}.parquet"  # a pattern may name a file or a folder; a plain path must be a folder
    return t.spark.readStream.schema(t(name).schema).option("maxBytesPerTrigger", BATCH_BYTES).parquet(either)


@query("st1_running_state", RUNNING)
def st1(t):
    return ss.run_available(ss.stream_running_state(_stream(t, "conversations")), "st1")


# One fold per user over its transitions: weights so far, steps so far, rows to emit.
_OLD, _NEXT = "coalesce(acc.w[x.s || '|' || x.a], 0.0::DOUBLE)", "coalesce(acc.w[x.s_next || '|' || x.a], 0.0::DOUBLE)"
_NEW = (f"({_OLD} + (50.0::DOUBLE / (50.0::DOUBLE + 1.0::DOUBLE / sqrt(acc.n + 1))) * "
        f"(x.r + 0.9::DOUBLE * {_NEXT} - {_OLD}))")
_FOLD = f"""list_reduce(steps, lambda acc, x: {{
    'w': map_concat(acc.w, MAP([x.s || '|' || x.a], [{_NEW}])), 'n': acc.n + 1,
    'o': list_append(acc.o, {{'event_id': x.event_id, 's': x.s, 'a': x.a, 'w': {_NEW}}})}},
  {{'w': MAP([]::VARCHAR[], []::DOUBLE[]), 'n': 0::BIGINT,
    'o': []::STRUCT(event_id BIGINT, s VARCHAR, a VARCHAR, w DOUBLE)[]}})"""


@query("st2_q_update", f"""
    SELECT user_id, o.event_id, o.s, o.a, round(o.w, 6) AS w FROM (SELECT user_id, unnest(({_FOLD}).o) AS o FROM (
      SELECT user_id, list({{'event_id': event_id, 's': s, 'a': a, 'r': r, 's_next': s_next}} ORDER BY ts, event_id) AS steps
      FROM {TRANSITIONS} WHERE s_next IS NOT NULL GROUP BY user_id))""")
def st2(t):
    k = F.get_json_object("props", "$.k").cast("int")
    steps = _stream(t, "events").select(
        "user_id", "ts", "event_id", F.col("event_type").alias("s"),
        F.concat(F.lit("k"), F.floor(k / 20).cast("string")).alias("a"), F.col("value").alias("r"))
    return ss.run_available(ss.stream_q_update(steps, 0.9), "st2").withColumn("w", F.round("w", 6))


@query("st3_stream_records", """
    SELECT conv_id, turn, len(list_filter(regexp_split_to_array(translate(text, '[{();$', '______'), '\\s+'), lambda w:
      regexp_replace(w, '^[0-9]+\\.+', '') NOT IN ('', '1-0', '0-1', '1/2-1/2', '*')))::INT AS n_moves
    FROM conversations WHERE role <> 'system'""")
def st3(t):
    """Turns written as record files; system turns lack a player and must be skipped."""
    path = scratch_path(t.spark, "records")
    white = F.when(F.col("role") == "system", "").otherwise(F.concat(F.lit('[White "'), "role", F.lit('"]\n')))
    text = F.translate("text", "[{();$", "______")
    record = F.concat(F.lit('[Event "'), F.concat_ws(" ", "conv_id", "turn"), F.lit('"]\n'), white,
                      F.lit('[Black "x"]\n\n1. '), text)
    t("conversations").select(record.alias("value")).write.option("lineSep", "\n\n").text(path)
    games = ss.run_available(ss.stream_records(t.spark, path), "st3")
    ids = F.split(F.col("headers")["Event"], " ")
    return games.select(ids[0].cast("bigint").alias("conv_id"), ids[1].cast("bigint").alias("turn"), F.size("moves").alias("n_moves"))
