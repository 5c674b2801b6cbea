"""Golden cases of array, board and scalar formulas."""

import math

import pytest
from pyspark.sql import functions as F

from corvane.functions import arrays as ar


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def arr(*items):
    return F.array(*[F.lit(i) for i in items])


START = (list("RNBQKBNR") + ["P"] * 8 + ["."] * 32 + ["p"] * 8 + list("rnbqkbnr"))


def test_encode_passes_numbers_through(spark):
    assert one(spark, ar.encode_symbols(arr("p", "50", "34"), ar.PIECE_CODES)) == [-60, 50, 34]


def test_decode_last_wins(spark):
    got = one(spark, ar.decode_values(arr(45, -45, 150, 0, 7), ar.WEIGHT_PIECES))
    assert got == ["knight/white", "bishop/black", "king/white", "./.", "7"] or got[3] == "."
    assert got[:3] == ["knight/white", "bishop/black", "king/white"] and got[4] == "7"


def test_material(spark):
    assert one(spark, ar.material_score(arr(*START))) == 0
    assert one(spark, ar.material_score(arr(*["." if s == "q" else s for s in START]))) == 9
    assert one(spark, ar.score_with_mobility(F.lit(9), F.lit(True), F.lit(20))) == pytest.approx(11.0)
    assert one(spark, ar.score_with_mobility(F.lit(9), F.lit(False), F.lit(20))) == pytest.approx(9.0)
    assert one(spark, ar.count_symbol(arr(*START), "P")) == 8


def test_scaled_weights():
    table = ar.scaled_weights()
    assert [table[w] for w in (0, 15, 45, 75, 100, 150)] == [0, 0.1, 0.3, 0.5, 0.6667, 1]
    assert table[-45] == -0.3


def test_squares(spark):
    assert one(spark, ar.square_xy(F.lit(12), "W")) == [4, 6]
    assert one(spark, ar.square_xy(F.lit(12), "B")) == [3, 1]
    assert one(spark, ar.delta(arr(1, 5), arr(4, 3))) == [3, -2]


def test_reshape_and_flips(spark):
    m = ar.reshape(arr(*range(64)), 8, 8)
    board = [list(range(r * 8, r * 8 + 8)) for r in range(8)]
    assert one(spark, m) == board
    assert one(spark, ar.flip_rows(m)) == board[::-1]
    assert one(spark, ar.flip_cols(m)) == [r[::-1] for r in board]
    assert one(spark, ar.flip_rows(ar.flip_rows(m))) == board
    assert one(spark, ar.flip_cols(ar.flip_cols(m))) == board
    # A square's (x, y) in the white view is where the flipped board shows it.
    for i in (0, 12, 63):
        x, y = one(spark, ar.square_xy(F.lit(i), "W"))
        assert board[::-1][y][x] == i
        x, y = one(spark, ar.square_xy(F.lit(i), "B"))
        assert board[y][::-1][x] == i


def test_scalars(spark):
    assert [one(spark, ar.ceil_to_tens(F.lit(float(x)))) for x in (-41, 0, 1, 10, 11)] == [-40, 0, 10, 10, 20]
    assert one(spark, ar.euclid(F.lit(0.0), F.lit(0.0), F.lit(3.0), F.lit(4.0))) == 5
    assert one(spark, ar.euclid(F.lit(0.0), F.lit(0.0), F.lit(3.0), F.lit(4.0), 7.0, -2.0)) == pytest.approx(5)
    assert one(spark, ar.curve(F.lit(2.0))) == pytest.approx(2 * math.exp(1 / 3) * math.sin(0.4))
    assert one(spark, ar.rate(ar.step_size(F.lit(4)))) == pytest.approx(50 / 50.5)
