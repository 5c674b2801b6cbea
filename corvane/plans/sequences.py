"""Window and ordered-sequence queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import arrays as ar
from corvane.functions import text as tx
from corvane.operators import rows as rw
from corvane.operators import sequences as sq
from corvane.plans import query
from corvane.plans.rows import BOARD, board, sql_map
from corvane.scale import lookup_join

TYPES = ["click", "error", "purchase", "signup", "view"]
KEY, ORDER = ["user_id"], ["ts", "event_id"]
OVER = "(PARTITION BY user_id ORDER BY ts, event_id)"
ACTION = "'k' || ((props->>'$.k')::INT // 20)"


def event_transitions(t):
    k = F.get_json_object("props", "$.k").cast("int")
    action = F.concat(F.lit("k"), F.floor(k / 20).cast("string"))
    events = t("events").select("user_id", "ts", "event_id", "event_type", "value", "props")
    return sq.transitions(events, KEY, ORDER, "event_type", action, "value")


TRANSITIONS = f"""(SELECT user_id, ts, event_id, event_type AS s, {ACTION} AS a, value AS r,
    lead(event_type) OVER {OVER} AS s_next FROM events)"""


@query("w1_turn_index", f"""
    SELECT event_id, user_id, lpad(i::VARCHAR, greatest(3, length(i::VARCHAR))::INT, '0') AS turn_count, i // 2 + 1 AS full_move_count,
           CASE WHEN i % 2 = 0 THEN 'W' ELSE 'B' END AS turn_color
    FROM (SELECT event_id, user_id, row_number() OVER {OVER} - 1 AS i FROM events)""")
def w1(t):
    out = sq.turn_index(t("events").select("event_id", "user_id", "ts"), KEY, ORDER)
    return out.withColumn("turn_count", tx.zfill(F.col("turn_count"), 3)).drop("ts")


_STATE = " || ' ' || ".join(f"coalesce(sum((event_type = '{s}')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id "
                            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)" for s in TYPES)
_STEPS = f"""SELECT user_id, row_number() OVER {OVER} - 1 AS step, {_STATE} AS state, event_type AS action, event_id
    FROM events"""
_FINAL = " || ' ' || ".join(f"sum((event_type = '{s}')::INT)" for s in TYPES)


@query("w2_state_before_action", _STEPS)
def w2(t):
    out = sq.trajectory(t("events"), KEY, ORDER, "event_type", TYPES, keep=["event_id"])
    return out.withColumn("state", F.array_join("state", " "))


@query("w2_message_history", """
    SELECT a.conv_id, a.turn, a.role, coalesce(string_agg(b.role || ': ' || b.text, chr(10) ORDER BY b.turn), '') AS state
    FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn < a.turn AND b.turn >= a.turn - 4
    GROUP BY a.conv_id, a.turn, a.role""")
def w2_history(t):
    seen = sq.recent(t("conversations"), ["conv_id"], ["turn"], 4, ["role", "text"])
    lines = F.transform("history", lambda m: F.concat(m["role"], F.lit(": "), m["text"]))
    return seen.select("conv_id", "turn", "role", F.array_join(lines, "\n").alias("state"))


_CODES = f"list_transform({BOARD}, lambda x: {sql_map(ar.PIECE_CODES)}[x])"


@query("w2_position_rows", f"""
    SELECT 'game' || '0x' || lpad(lower(to_hex(label::BIGINT)), 3, '0') AS id, CASE WHEN i % 2 = 0 THEN 'white' ELSE 'black' END AS player,
      i // 2 + 1 AS full_move_count, lpad(i::VARCHAR, greatest(3, length(i::VARCHAR))::INT, '0') AS turn_count, CASE WHEN i % 2 = 0 THEN 'W' ELSE 'B' END AS turn_color,
      array_to_string(state, ' ') AS state, state[f + 1] AS moved_piece, f AS moved_from, g AS moved_to,
      ((g % 8) - (f % 8))::INT AS dx, ((7 - g // 8) - (7 - f // 8))::INT AS dy
    FROM (SELECT label, vec_id, {_CODES} AS state, (list_position(embedding, list_max(embedding)) - 1)::INT AS f,
            (list_position(embedding, list_min(embedding)) - 1)::INT AS g,
            row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i FROM embeddings)""")
def w2_positions(t):
    """Boards in order as position rows: the vectors of a label are one game, the move goes
    from the largest to the smallest value."""
    e = F.col("embedding")
    codes = ar.encode_symbols(board(), ar.PIECE_CODES)
    at_max, at_min = F.array_position(e, F.array_max(e)) - 1, F.array_position(e, F.array_min(e)) - 1
    move = F.struct(F.get(codes, at_max.cast("int")).alias("moved_piece"), at_max.cast("int").alias("moved_from"),
                    at_min.cast("int").alias("moved_to"))
    rows = t("embeddings").select("label", "vec_id", codes.alias("state"), move.alias("move"))
    turns = rw.flatten_struct(sq.turn_index(rows, ["label"], ["vec_id"]), "move")
    way = ar.delta(ar.square_xy(F.col("moved_from"), "W"), ar.square_xy(F.col("moved_to"), "W"))
    return turns.select(
        tx.hex_id(F.lit("game"), F.col("label")).alias("id"), F.when(F.col("turn_color") == "W", "white").otherwise("black").alias("player"),
        "full_move_count", tx.zfill(F.col("turn_count"), 3).alias("turn_count"), "turn_color",
        F.array_join("state", " ").alias("state"), "moved_piece", "moved_from", "moved_to", way[0].alias("dx"), way[1].alias("dy"))


@query("w3_terminal_rows", f"""{_STEPS} UNION ALL
    SELECT user_id, count(*), {_FINAL}, NULL, NULL FROM events GROUP BY user_id""")
def w3(t):
    out = sq.trajectory(t("events"), KEY, ORDER, "event_type", TYPES, terminal=True, keep=["event_id"])
    return out.withColumn("state", F.array_join("state", " "))


@query("w4_dedup_adjacent", f"""
    SELECT event_id, user_id, event_type FROM events QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER {OVER}""")
def w4(t):
    out = sq.dedup_adjacent(t("events").select("event_id", "user_id", "ts", "event_type"), KEY, ORDER, "event_type")
    return out.drop("ts")


@query("w4_take_until_repeat", f"""
    SELECT event_id, user_id FROM (SELECT *, sum((event_type = p)::INT) OVER {OVER} AS reps FROM (
      SELECT *, lag(event_type) OVER {OVER} AS p FROM events)) WHERE coalesce(reps, 0) = 0""")
def w4_stop(t):
    out = sq.take_until_repeat(t("events").select("event_id", "user_id", "ts", "event_type"), KEY, ORDER, "event_type")
    return out.select("event_id", "user_id")


def station_lines(t):
    """Suppliers as stations, each on the line of its nation and the line of its region."""
    s = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("double").alias("x"),
                             F.col("s_acctbal").alias("y"), "s_nationkey")
    n = t("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    lines = F.array("n_name", F.concat(F.lit("region "), F.col("n_regionkey").cast("string")))
    return lookup_join(s, n, ["s_nationkey"], "inner").select("id", "x", "y", F.explode(lines).alias("line"))


STATIONS = """stations AS (SELECT s_suppkey AS id, s_nationkey::DOUBLE AS x, s_acctbal AS y,
      unnest([n_name, 'region ' || n_regionkey]) AS line FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    placed AS (SELECT id, line, x, y, sqrt((ex-x)*(ex-x) + (ey-y)*(ey-y)) AS dist FROM stations JOIN
      (SELECT line, arg_min(x, id) AS ex, arg_min(y, id) AS ey FROM stations GROUP BY line) e USING (line)),
    linked AS (SELECT id, line, lag(id) OVER w AS prev, lead(id) OVER w AS next, dist FROM placed
      WINDOW w AS (PARTITION BY line ORDER BY dist, id))"""


@query("w5_line_neighbours", f"WITH {STATIONS} SELECT id, line, prev, next, round(dist, 6) AS dist FROM linked")
def w5(t):
    out = sq.line_neighbours(station_lines(t))
    return out.select("id", "line", "prev", "next", F.round("dist", 6).alias("dist"))


@query("w5_neighbour_lists", f"""WITH {STATIONS}
    SELECT id, array_to_string(list_sort(list(DISTINCT n)), ' ') AS neigh
    FROM (SELECT id, unnest([prev, next]) AS n FROM linked) WHERE n IS NOT NULL GROUP BY id""")
def w5_lists(t):
    return sq.neighbour_lists(sq.line_neighbours(station_lines(t))).withColumn("neigh", F.array_join("neigh", " "))


@query("w7_prefix", f"SELECT event_id, user_id FROM events QUALIFY row_number() OVER {OVER} <= 24")
def w7(t):
    return sq.prefix(t("events").select("event_id", "user_id", "ts"), KEY, ORDER, 24).drop("ts")


@query("w8_transitions", f"SELECT event_id, s, a, r, s_next FROM {TRANSITIONS}")
def w8(t):
    return event_transitions(t).select("event_id", "s", "a", "r", "s_next")


@query("w9_first_seen", """
    SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL""")
def w9(t):
    return sq.first_seen(t("events"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"])


@query("w10_every_n", "SELECT event_id, event_type, value FROM events WHERE event_id % 100 = 0")
def w10(t):
    return sq.every_n(t("events").select("event_id", "event_type", "value"), "event_id", 100)


_UPTO = "(PARTITION BY conv_id ORDER BY turn)"
RUNNING = f"""SELECT conv_id, turn, sum((role = 'system')::INT) OVER {_UPTO}::BIGINT AS n_system,
    sum((role = 'user')::INT) OVER {_UPTO}::BIGINT AS n_user, sum((role = 'assistant')::INT) OVER {_UPTO}::BIGINT AS n_assistant,
    sum(length(text)) OVER {_UPTO}::BIGINT AS n_chars, count(*) OVER {_UPTO} AS n_messages,
    role AS last_role, text AS last_text FROM conversations"""


@query("w11_running_state", RUNNING)
def w11(t):
    return sq.running_state(t("conversations"), ["conv_id"], ["turn"], "role", "text")


@query("w11_recent_messages", """
    SELECT a.conv_id, a.turn, string_agg(b.role || ': ' || b.text, chr(10) ORDER BY b.turn) AS messages
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn BETWEEN a.turn - 7 AND a.turn
    GROUP BY a.conv_id, a.turn""")
def w11_recent(t):
    seen = sq.recent(t("conversations"), ["conv_id"], ["turn"], 8, ["role", "text"], include_self=True)
    lines = F.transform("history", lambda m: F.concat(m["role"], F.lit(": "), m["text"]))
    return seen.select("conv_id", "turn", F.array_join(lines, "\n").alias("messages"))
