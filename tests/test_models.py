"""Conformed tables, marts and checks on hand-made games."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rookery.operators import checks
from rookery.operators.carry import carry_forward
from rookery.plans import gold, quality, silver
from tests.conftest import SAMPLES, game, one, side

T1, T2 = dt.datetime(2026, 9, 1, 10), dt.datetime(2026, 9, 2, 10)


def test_newest_copy_of_a_game_wins_ties_by_endpoint(raw):
    records = [
        game(1, _ingested_at=T1, fen="old"),
        game(1, _ingested_at=T2, _source_endpoint="player/b", fen="new-b"),
        game(1, _ingested_at=T2, _source_endpoint="player/a", fen="new-a"),
    ]
    assert one(silver.clean_games(raw(records))).final_fen == "new-a"


def test_rows_without_id_date_or_standard_rules_are_left_out(raw):
    records = [
        game(1, url="https://x/live/none"), game(2, end_time=None), game(3, rules=None),
        game(4, rules="threecheck"), game(5),
    ]
    assert [r.game_id for r in silver.clean_games(raw(records)).collect()] == ["5"]


def test_window_is_inclusive_and_prunes_landing_months(raw):
    records = [game(1), game(2, end_time=1_788_220_799), game(3, month=7)]  # 2: 2026-08-31 23:59:59
    window = (dt.date(2026, 8, 15), dt.date(2026, 8, 31))
    exact = silver.clean_games(raw(records), *window, slack_months=0)
    assert {r.game_id for r in exact.collect()} == {"1", "2"}
    wide = silver.clean_games(raw(records), *window)  # one month more by default
    assert {r.game_id for r in wide.collect()} == {"1", "2", "3"}


def test_conformed_values(raw):
    row = one(silver.clean_games(raw([game(1, time_class="Puzzle", white=side("Anna", None, "Win"))])))
    assert (row.time_class, row.player_white, row.elo_bracket_white) == ("unknown", "anna", None)
    assert (row.outcome, row.winner_username, row.is_draw, row.eco_code) == ("1-0", "anna", False, "B90")
    assert (row.total_moves, row.game_date) == (20, dt.date(2026, 8, 15))


def test_player_results_score_both_sides(raw):
    rows = silver.player_game_results(silver.clean_games(raw())).collect()
    assert len(rows) == 6
    got = {(r.game_id, r.color): (r.username, r.score, r.result) for r in rows}
    assert got[("98235123", "white")] == ("anna", 0.0, "loss")
    assert got[("98235123", "black")] == ("carl", 1.0, "win")
    assert got[("98234999", "white")] == ("bert", 0.5, "draw")


def test_daily_first_and_last_rating_break_ties_by_game(raw):
    at = 1_786_795_200
    records = [
        game(11, white=side("Anna", 2000, "win"), end_time=at),
        game(12, white=side("Anna", 2010, "win"), end_time=at),
        game(13, white=side("Anna", None, "win"), end_time=at - 5),
    ]
    kpis = gold.daily_player_kpis(silver.clean_games(raw(records)))
    row = one(kpis.filter("username = 'anna'"))
    assert (row.games_played, row.elo_first, row.elo_last, row.elo_delta) == (3, None, 2010, None)


def test_weekly_trend_tells_the_gap(raw):
    day = 86_400
    monday = 1_786_924_800 - 0  # 2026-08-17 00:00 UTC
    records = [
        game(21, white=side("Anna", 2000, "win"), end_time=monday),
        game(22, white=side("Anna", 2020, "win"), end_time=monday + 6 * day),
        game(23, white=side("Anna", 2050, "win"), end_time=monday + 21 * day),
        game(24, white=side("Anna", 1000, "win"), end_time=monday + 22 * day, rated=False),
    ]
    rows = (
        gold.elo_trend_weekly(silver.clean_games(raw(records)))
        .filter("username = 'anna'").orderBy("week_start_date").collect()
    )
    assert [(r.week_start_date, r.closing_elo, r.elo_change_wow, r.weeks_since_prev_active) for r in rows] == [
        (dt.date(2026, 8, 17), 2020, None, None), (dt.date(2026, 9, 7), 2050, 30, 3),
    ]


def test_opening_without_a_name_is_unknown(spark, raw):
    games = silver.clean_games(raw([game(1, eco=None), game(2)]))
    dim = silver.openings_dim(games)
    assert one(dim).opening_name == "Sicilian Defense Main Line"
    empty = dim.filter("false")
    assert one(gold.opening_win_rates(games, empty)).opening_name == "Unknown"


def test_time_control_leaves_correspondence_out_of_clock_means(raw):
    records = [game(1, time_control="1/259200", time_class="daily"), game(2, time_class="daily")]
    row = one(gold.time_control_meta(silver.clean_games(raw(records))))
    assert (row.daily_games, row.avg_base_time_sec) == (1, 600.0)


def test_checks_and_gate(raw):
    window = (dt.date(2026, 8, 1), dt.date(2026, 8, 31))
    as_of = dt.date(2026, 9, 1)
    good = quality.dq_results(silver.clean_games(raw()), "r1", *window, as_of)
    assert good.count() == 17 and good.filter("NOT passed").count() == 0
    checks.gate(good)

    games = silver.clean_games(raw([game(1, black=side("Anna", 9000, "newdraw")), game(2)]))
    bad = quality.dq_results(games.union(games.filter("game_id = '2'")), "r2", *window, as_of)
    failed = {r.check_name: r.failed_rows for r in bad.filter("NOT passed").collect()}
    assert failed["game_id_unique"] == 1 and failed["no_self_play"] == 1 and failed["elo_in_range"] == 1
    with pytest.raises(checks.ChecksFailed, match="no_self_play"):
        checks.gate(bad)

    nothing = quality.dq_results(games.filter("false"), "r3", *window, as_of)
    empty = {r.check_name: r for r in nothing.collect()}
    assert not empty["rows_present"].passed and empty["rows_present"].total_rows == 1
    assert empty["game_id_unique"].failed_pct == 0.0 and empty["game_id_unique"].passed


def test_carry_forward_crosses_blocks_of_a_hot_key(spark):
    rows = [(1, i, float(i) if i % 7 == 0 else None) for i in range(500)] + [(2, 3, None)]
    frame = spark.createDataFrame(rows, "k INT, t INT, v DOUBLE")
    got = carry_forward(frame, ["k"], ["t"], {"seen": F.col("v")}, F.floor(F.col("t") / 3))
    for r in got.collect():
        assert r.seen == (None if r.k == 2 else float(r.t - r.t % 7))


def test_samples_have_the_known_facts(raw):
    rows = {r.game_id: r for r in silver.clean_games(raw()).collect()}
    assert rows["98234571"].total_moves == 20
    assert rows["98234999"].total_moves == 16
    assert (rows["98235123"].total_moves, rows["98235123"].termination) == (10, "resignation")
    assert len(SAMPLES) == len(rows)
