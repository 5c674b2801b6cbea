"""Array, board and scalar formulas as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Piece codes, upper case for one side and lower case for the other.
PIECE_CODES = {"p": -60, "r": -50, "n": -40, "b": -30, "q": -20, "k": -10, ".": 0,
               "K": 10, "Q": 20, "B": 30, "N": 40, "R": 50, "P": 60}
PIECE_WEIGHTS = {"p": -15, "r": -75, "n": -45, "b": -45, "q": -100, "k": -150, ".": 0,
                 "K": 150, "Q": 100, "B": 45, "N": 45, "R": 75, "P": 15}
# Fixed values: (code, piece, side) rows in listing order; a repeated code keeps its last row.
WEIGHT_PIECES = [(-15, "pawn", "black"), (-75, "rook", "black"), (-45, "knight", "black"),
                 (-45, "bishop", "black"), (-100, "queen", "black"), (-150, "king", "black"),
                 (0, ".", "."),
                 (150, "king", "white"), (100, "queen", "white"), (45, "bishop", "white"),
                 (45, "knight", "white"), (75, "rook", "white"), (15, "pawn", "white")]
# Symmetric evaluation, 200 K + 9 Q + 5 R + 3 (B, N) + 1 P.
MATERIAL = {"K": 200, "Q": 9, "R": 5, "N": 3, "B": 3, "P": 1}
# Absolute piece weights that are scaled to [0, 1].
BOARD_WEIGHTS = [0, 15, 45, 75, 100, 150]


def literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(v) for pair in table.items() for v in pair])


def encode_symbols(arr: Column, table: dict) -> Column:
    """Replace array items found in ``table``; others pass through as integers or null."""
    lookup = literal_map({str(k): v for k, v in table.items()})
    return F.transform(arr, lambda x: F.coalesce(F.try_element_at(lookup, x.cast("string")),
                                                 x.try_cast("int")))


def decode_values(arr: Column, rows: list[tuple]) -> Column:
    """Reverse lookup of codes where a later row replaces an earlier one; unmapped stay text."""
    table = {code: "/".join(names) for code, *names in rows}
    lookup = literal_map(table)
    return F.transform(arr, lambda x: F.coalesce(F.try_element_at(lookup, x), x.cast("string")))


def reshape(arr: Column, rows: int, cols: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda r: F.slice(arr, r * cols + 1, cols))


def flip_rows(matrix: Column) -> Column:
    return F.reverse(matrix)


def flip_cols(matrix: Column) -> Column:
    return F.transform(matrix, F.reverse)


def map_matrix(matrix: Column, table: dict) -> Column:
    lookup = literal_map(table)
    return F.transform(matrix, lambda row: F.transform(row, lambda x: F.try_element_at(lookup, x)))


def widen(arr: str, n: int, prefix: str = "") -> list[Column]:
    """One column per array item, named by position."""
    return [F.get(F.col(arr), F.lit(i)).alias(f"{prefix}{i}") for i in range(n)]


def square_xy(index: Column, view: str) -> Column:
    """(x, y) of a board index as the white or the black side sees it."""
    row, col = F.floor(index / 8).cast("int"), (index % 8).cast("int")
    if view == "W":
        return F.array(col, 7 - row)
    return F.array(7 - col, row)


def delta(u: Column, v: Column) -> Column:
    return F.zip_with(v, u, lambda a, b: a - b)


def euclid(ax: Column, ay: Column, bx: Column, by: Column,
           ox: Column | float = 0.0, oy: Column | float = 0.0) -> Column:
    """Distance of two points; the origin is accepted and cancels out."""
    dx = (ox - ax) - (ox - bx) if not isinstance(ox, float) or ox else ax - bx
    dy = (oy - ay) - (oy - by) if not isinstance(oy, float) or oy else ay - by
    return F.sqrt(dx * dx + dy * dy)


def ceil_to_tens(col: Column) -> Column:
    return F.ceil(col / 10.0).cast("int") * 10


def curve(x: Column) -> Column:
    """2 exp(1 / (|x| + 1)) sin(0.1 x^2)."""
    return F.lit(2.0) * F.exp(F.lit(1.0) / (F.abs(x) + 1.0)) * F.sin(F.lit(0.1) * x * x)


def step_size(n: Column) -> Column:
    return F.lit(1.0) / F.sqrt(n)


def rate(step: Column) -> Column:
    return F.lit(50.0) / (F.lit(50.0) + step)


def count_symbol(arr: Column, symbol: str) -> Column:
    return F.size(F.filter(arr, lambda x: x == symbol))


def symbol_weight(symbol: Column) -> Column:
    """Signed evaluation weight of one piece symbol, 0 for anything else."""
    table = {**MATERIAL, **{k.lower(): -v for k, v in MATERIAL.items()}}
    return F.coalesce(F.try_element_at(literal_map(table), symbol), F.lit(0))


def material_score(state: Column) -> Column:
    """Upper-case minus lower-case material of a state array."""
    return F.aggregate(state, F.lit(0), lambda acc, s: acc + symbol_weight(s))


def score_with_mobility(score: Column, turn: Column, options: Column) -> Column:
    """Add 0.1 per option, only while the turn flag is true."""
    return score + turn.cast("int") * 0.1 * options


def scaled_weights(weights: list[int] = BOARD_WEIGHTS) -> dict[int, float]:
    """Min-max scaled weights, rounded to 4 places and mirrored to negatives."""
    lo, hi = min(weights), max(weights)
    table = {w: round((w - lo) / (hi - lo), 4) for w in weights}
    table.update({-w: -v if w else v for w, v in list(table.items())})
    return table


def gaussian(u1: Column, u2: Column) -> Column:
    """Standard normal value from two uniforms in [0, 1)."""
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2 * math.pi) * u2)
