"""Scalar derivations and the move tokenizer."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rookery.functions import derive, moves, text
from rookery.plans import events as plays
from tests.conftest import values


def test_game_id_is_the_trailing_number(spark):
    urls = ["https://x/live/98234571", "https://x/live/123/", "https://x/live/abc", None, "https://x/live/7\n"]
    assert values(spark, derive.game_id, urls) == ["98234571", "123", None, None, None]


def test_time_control_parts(spark):
    controls = ["600", "180+2", "60+1", "1/259200", None, "odd"]
    assert values(spark, derive.base_seconds, controls) == [600, 180, 60, 259200, None, None]
    assert values(spark, derive.increment_seconds, controls) == [0, 2, 1, 0, 0, 0]
    assert values(spark, derive.is_correspondence, controls) == [False, False, False, True, None, False]


def test_opening_names_and_volumes(spark):
    urls = ["https://x/openings/Polar-Gambit-Accepted/", "https://x/openings/A-B", "x//", None]
    assert values(spark, derive.opening_name, urls) == ["Polar Gambit Accepted", "A B", None, None]
    codes = ["D07", "a45", "Z1", None]
    assert values(spark, derive.eco_volume, codes) == [
        "Closed and semi-closed games", "Flank openings", None, None,
    ]


def test_elo_brackets(spark):
    frame = spark.createDataFrame([(1420,), (1999,), (2000,), (2150,), (2799,), (2911,), (None,)], "e BIGINT")
    labels = [r[0] for r in frame.select(derive.elo_bracket(F.col("e"))).collect()]
    assert labels == ["u2000", "u2000", "2000_2199", "2000_2199", "2600_2799", "2800_plus", None]


@pytest.mark.parametrize(
    "white, black, outcome, winner, termination",
    [
        ("win", "checkmated", "1-0", "white", "checkmate"),
        ("resigned", "win", "0-1", "black", "resignation"),
        ("agreed", "agreed", "1/2-1/2", None, "draw_agreed"),
        ("50move", "50move", "1/2-1/2", None, "draw_50_move"),
        ("win", "asteroid", "1-0", "white", "unknown"),
        ("newdraw", "newdraw", "1/2-1/2", None, "unknown"),
        (None, None, "1/2-1/2", None, "unknown"),
    ],
)
def test_results(spark, white, black, outcome, winner, termination):
    frame = spark.createDataFrame([(white, black)], "w STRING, b STRING")
    w, b = F.col("w"), F.col("b")
    row = frame.select(derive.outcome(w, b), derive.winner_color(w, b), derive.termination(w, b)).first()
    assert tuple(row) == (outcome, winner, termination)


def test_clock_texts(spark):
    clocks = ["0:09:57.5", "0:01:00.9", "1:02:03", "59.9", None, "garbage", "1:xx"]
    assert values(spark, derive.clock_seconds, clocks) == [597.5, 60.9, 3723.0, 59.9, None, None, None]


def test_move_count_ignores_clocks_and_the_date_header(spark):
    game = '[Date "2026.08.15"]\n\n1. e4 {[%clk 0:09:57.5]} 1... e5 {[%clk 0:09:57.5]} 2. Nf3 1-0\n'
    got = values(spark, lambda c: derive.full_moves(derive.movetext(c)), [game, "[Event \"x\"]\n", None])
    assert got == [2, None, None]


@pytest.mark.parametrize(
    "movetext, expected",
    [
        ("1. g3 d5 2. Bg2", ["g3", "d5", "Bg2"]),
        ("1.b3 e6", ["b3", "e6"]),
        ("1. c4 $14 f5", ["c4", "f5"]),
        ("1. Nc3 {a remark} g6 1/2-1/2", ["Nc3", "g6"]),
        ("51. h8=N+ 0-1", ["h8=N+"]),
        ("1. e4 1... c5 *", ["e4", "c5"]),
        ("1. e4 20.1-0", ["e4"]),
        ("e4{a}c5", ["e4", "c5"]),
        ("1-0e4 12.", ["1-0e4"]),
        ("12...O-O-O Bxa3+", ["O-O-O", "Bxa3+"]),
        ("", []),
        ("\n 1. d4\n\td5 \n", ["d4", "d5"]),
    ],
)
def test_tokenizer(spark, movetext, expected):
    assert values(spark, moves.sans, [movetext]) == [expected]


def test_header_tags_last_of_a_repeated_tag_wins(spark):
    game = '[Event "a"]\n[ECO "A03"]\n[Event "b"]\n\n1. e4 [Not "header"]'
    assert values(spark, derive.header_tags, [game]) == [{"ECO": "A03", "Event": "b"}]


def test_explode_moves(spark, raw):
    played = plays.explode_moves(
        raw().withColumn("id", derive.game_id(F.col("url"))), ["id"], moves.stripped_movetext(F.col("pgn"))
    )
    counts = {r.id: r["count"] for r in played.groupBy("id").count().collect()}
    assert counts == {"98234571": 39, "98234999": 32, "98235123": 20}
    first = played.filter("id = '98235123' AND ply = 1").first()
    assert (first.move_number, first.color, first.san, first.clock) == (1, "white", "Ba1", "0:01:00.9")
    assert played.filter("id = '98234571' AND clock IS NOT NULL").count() == 0


def test_rate_and_json(spark):
    row = spark.range(1).select(
        text.rate(F.lit(1), F.lit(0)), text.rate(F.lit(1), F.lit(4)),
        text.json_field(F.lit('{"k": 69}'), "$.k"), text.json_field(F.lit("broken"), "$.k"),
    ).first()
    assert tuple(row) == (None, 0.25, "69", None)


def test_dates_are_utc(spark):
    row = spark.range(1).select(F.timestamp_seconds(F.lit(1_787_400_000)).cast("date")).first()
    assert row[0] == dt.date(2026, 8, 22)
