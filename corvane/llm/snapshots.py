"""Operator 6: collapse cumulative conversation snapshots and render the maximal ones; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.rows import materialize
from corvane.scale import Ordered

_SUMS = ["h0", "h1", "h2", "h3"]


def _halves(*parts: Column) -> dict[str, Column]:
    """Two 64-bit hashes as four non-negative 32-bit numbers, whose running sums cannot overflow."""
    out = {}
    for i in range(2):
        h = F.xxhash64(F.lit(i + 1), *parts)
        out[f"h{2 * i}"] = h.bitwiseAND(0xFFFFFFFF)
        out[f"h{2 * i + 1}"] = F.shiftrightunsigned(h, 32)
    return out


def render(role: Column, text: Column) -> Column:
    """One turn in the chat layout."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def maximal(turns: DataFrame) -> DataFrame:
    """Turns of the conversations that no longer logged conversation starts with, rendered.

    A conversation's turns are put in order of ``turn`` (null first), then role, then text. Every turn carries a
    rolling hash of the turns up to it: 128 bits, as running sums of hashes of (position, role, text). A
    conversation is dropped if its last hash is the hash of an inner turn of another one; of equal
    conversations the least ``conv_id`` stays. Hashes are grouped before they meet, so a first turn or a
    whole conversation that a third of the log shares is one row per task; a conversation of very many
    turns is cut into ranges whose sums are carried over.

    Returns one row per turn: ``conv_id``, ``n_turns``, ``n_copies`` (equal conversations), ``turn_ix``,
    ``role``, ``rendered``, ``at`` (characters before it); the renderings of a conversation in order are its
    whole text, which is never gathered into one row. Null role or text: as an empty one. Rows without a
    conv_id: one conversation of their own. Repeated turns: kept. Other columns are not read. Empty table:
    empty result.
    """
    own = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = Ordered(own, ["conv_id"], ["turn", "role", "text"]).index("turn_ix")
    numbered = placed.result().drop("turn").withColumn("rendered", render(F.col("role"), F.col("text")))
    hashes = _halves(F.col("turn_ix"), F.col("role"), F.col("text"))
    rolling = Ordered(numbered, ["conv_id"], ["turn_ix"], sizes=placed.sizes).lead(following="turn_ix") \
        .running(**hashes).running(inclusive=False, at=F.length("rendered").cast("bigint")).result()
    rolled = materialize(rolling.drop("text"), "turns")
    prefix = ["turn_ix", *_SUMS]
    ends = rolled.filter(F.col("following").isNull()).groupBy(*prefix) \
        .agg(F.min("conv_id").alias("kept"), F.count("*").alias("n_copies"))
    inner = rolled.filter(F.col("following").isNotNull()).select(*prefix).distinct()
    kept = materialize(ends.join(inner, prefix, "left_anti")
                       .select("kept", (F.col("turn_ix") + 1).alias("n_turns"), "n_copies"), "kept")
    return rolled.join(kept, F.col("conv_id").eqNullSafe(F.col("kept"))) \
        .select("conv_id", "n_turns", "n_copies", "turn_ix", "role", "rendered", "at")


SQL = """
    WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                 coalesce(text, '')) - 1 AS turn_ix, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
    r AS (SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered FROM t),
    p AS (SELECT *, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS prefix,
            lead(turn_ix) OVER (PARTITION BY conv_id ORDER BY turn_ix) AS following,
            coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id ORDER BY turn_ix
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at
          FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn_ix ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    k AS (SELECT prefix, min(conv_id) AS conv_id, count(*) AS n_copies, max(turn_ix) + 1 AS n_turns FROM p
          WHERE following IS NULL AND prefix NOT IN (SELECT prefix FROM p WHERE following IS NOT NULL) GROUP BY prefix)
    SELECT p.conv_id, k.n_turns, k.n_copies, p.turn_ix, p.role, p.rendered, p.at
    FROM p JOIN k ON p.conv_id IS NOT DISTINCT FROM k.conv_id"""
