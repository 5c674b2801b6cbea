"""Game-record text: one row per game with its header tags and move tokens."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SEP = "\n[Event "  # also ends a line of "\r\n"
_HEADER = r'\[(\w+) "([^"]*)"\]'
_MOVE_NUMBER = r"^[0-9]+\.+"
# Game results, which end a move text and are not moves.
RESULTS = ("1-0", "0-1", "1/2-1/2", "*")


def moves(text: Column) -> Column:
    """Move tokens of the main line: no move numbers, comments (braces, or ``;`` to the end of the line),
    glyphs (``$n``), variations in parentheses and result."""
    plain = F.regexp_replace(F.regexp_replace(text, r"\{[^}]*\}", " "), r";[^\n]*", " ")
    plain = _outside_brackets(F.regexp_replace(plain, r"\$[0-9]+", " "))
    tokens = F.transform(F.split(plain, r"\s+"), lambda t: F.regexp_replace(t, _MOVE_NUMBER, ""))
    return F.filter(tokens, lambda t: (t != "") & ~t.isin(*RESULTS))


def _outside_brackets(text: Column) -> Column:
    """Text outside parentheses of any depth, in one pass over the pieces between them.

    A closing parenthesis without an opening one is dropped; one never closed runs to the end.
    """
    def step(state: Column, piece: Column) -> Column:
        opens, closes = F.startswith(piece, F.lit("(")), F.startswith(piece, F.lit(")"))
        depth = F.when(opens, state["depth"] + 1).when(closes, F.greatest(state["depth"] - 1, F.lit(0))).otherwise(state["depth"])
        rest = F.regexp_replace(piece, "^[()]", " ")
        return F.struct(depth.alias("depth"), F.when(depth == 0, F.array_append(state["kept"], rest)).otherwise(state["kept"]).alias("kept"))

    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))
    return F.aggregate(F.split(text, "(?=[()])"), start, step, lambda state: F.array_join(state["kept"], ""))


def parse_game_records(records: DataFrame, text: str = "value", cap: int | None = None) -> DataFrame:
    """(headers, moves) per record; undecodable records and those without both players are skipped.

    Lines may end in ``\n`` or ``\r\n``. ``cap`` keeps that many games, as a limit on the parsed table.
    """
    body = F.replace(F.col(text), F.lit("\r\n"), F.lit("\n"))
    first = F.startswith(F.ltrim(body), F.lit("[Event "))
    whole = F.when(first, F.ltrim(body)).otherwise(F.concat(F.lit("[Event "), body))
    parts = F.split(whole, "\n\n", 2)
    rest = [c for c in records.columns if c != text]
    split = records.filter(F.is_valid_utf8(text)).select(
        *rest, F.get(parts, F.lit(0)).alias("__h"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("__m"))
    tags = split.select(*rest, "__m", F.regexp_extract_all("__h", F.lit(_HEADER), F.lit(1)).alias("__k"),
                        F.regexp_extract_all("__h", F.lit(_HEADER), F.lit(2)).alias("__v"))
    keys, values = F.col("__k"), F.col("__v")
    # A repeated tag keeps its last value: only positions with no later equal tag remain.
    last = F.filter(F.transform(keys, lambda k, i: F.struct(k.alias("k"), F.get(values, i).alias("v"), i.alias("i"))),
                    lambda e: F.array_position(F.reverse(keys), e["k"]) == F.size(keys) - e["i"])
    headers = F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))
    parsed = tags.select(*rest, headers.alias("headers"), moves(F.col("__m")).alias("moves"))
    good = parsed.filter(F.col("headers")["White"].isNotNull() & F.col("headers")["Black"].isNotNull())
    return good if cap is None else good.limit(cap)


def read_game_records(spark: SparkSession, path: str | Sequence[str], cap: int | None = None) -> DataFrame:
    """Games of one or many record files; a file is split at record boundaries, not read whole."""
    return parse_game_records(spark.read.option("lineSep", _SEP).text(path), "value", cap)


def load_ordered(*frames: DataFrame) -> DataFrame:
    """Sources appended in order, numbered in column ``source``."""
    numbered = [f.withColumn("source", F.lit(i)) for i, f in enumerate(frames)]
    return reduce(DataFrame.unionByName, numbered)
