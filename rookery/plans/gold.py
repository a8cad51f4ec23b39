"""Marts over the conformed tables.

``as_of`` stands for today wherever a model depends on it, so that a rebuild of
an old state gives the old result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from rookery.functions.text import rate, share
from rookery.operators.extremes import value_at_first, value_at_last
from rookery.operators.trend import week_of, whole_weeks, with_previous
from rookery.plans.silver import in_window, player_game_results

SIGNIFICANT_GAMES = 30
SIGNIFICANT_PLAYERS = 10
ACTIVE_DAYS = 30


def _games() -> Column:
    return F.count(F.lit(1))


def _chronological() -> tuple[Column, ...]:
    """Order of a player's games. The colour only matters in games against oneself."""
    return F.col("ended_at"), F.col("game_id"), F.col("color")


def daily_player_kpis(
    games: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Results of a player on a day in a format.

    First and last rating are min_by/max_by aggregates, so the model needs no
    window. The distinct openings are counted in two levels: a player with very
    many games on a day is spread over opening codes before the last step.
    """
    used = ["game_id", "game_date", "ended_at", "time_class", "eco_code", "total_moves",
            "username", "color", "elo", "opponent_elo", "score", "result"]
    played = player_game_results(games.filter(in_window("game_date", start, end)), used)
    order = _chronological()
    return (
        played.groupBy("game_date", "username", "time_class")
        .agg(
            _games().alias("games_played"),
            F.count_if(F.col("result") == "win").alias("wins"),
            F.count_if(F.col("result") == "loss").alias("losses"),
            F.count_if(F.col("result") == "draw").alias("draws"),
            share(F.col("result") == "win").alias("win_rate"),
            F.avg("score").alias("score_rate"),
            F.count_if(F.col("color") == "white").alias("games_as_white"),
            F.count_if(F.col("color") == "black").alias("games_as_black"),
            F.avg("total_moves").alias("avg_total_moves"),
            value_at_first(F.col("elo"), *order).alias("elo_first"),
            value_at_last(F.col("elo"), *order).alias("elo_last"),
            F.avg("opponent_elo").alias("avg_opponent_elo"),
            F.count_distinct("eco_code").alias("distinct_openings"),
        )
        .select(
            "game_date",
            "username",
            "time_class",
            "games_played",
            "wins",
            "losses",
            "draws",
            "win_rate",
            "score_rate",
            "games_as_white",
            "games_as_black",
            "avg_total_moves",
            "elo_first",
            "elo_last",
            (F.col("elo_last") - F.col("elo_first")).alias("elo_delta"),
            "avg_opponent_elo",
            "distinct_openings",
            F.current_timestamp().alias("_transformed_at"),
        )
    )


def elo_trend_weekly(games: DataFrame) -> DataFrame:
    """Rating course of a player per week and format.

    The lag runs over weekly rows only: at most one per calendar week and key.
    """
    used = ["game_id", "game_date", "ended_at", "time_class", "username", "color", "elo", "score"]
    rated = player_game_results(games.filter("rated"), used).filter(F.col("elo").isNotNull())
    order = _chronological()
    weekly = (
        rated.withColumn("week_start_date", week_of("game_date"))
        .groupBy("week_start_date", "username", "time_class")
        .agg(
            _games().alias("games_played"),
            F.avg("score").alias("score_rate"),
            F.avg(F.col("elo").cast("double")).alias("avg_elo"),
            F.min("elo").alias("min_elo"),
            F.max("elo").alias("max_elo"),
            value_at_first(F.col("elo"), *order).alias("opening_elo"),
            value_at_last(F.col("elo"), *order).alias("closing_elo"),
        )
    )
    lagged = with_previous(
        weekly,
        ["username", "time_class"],
        "week_start_date",
        {"prev_week_closing_elo": "closing_elo", "prev_week_start_date": "week_start_date"},
    )
    return lagged.select(
        "week_start_date",
        "username",
        "time_class",
        "games_played",
        "score_rate",
        "avg_elo",
        "min_elo",
        "max_elo",
        "opening_elo",
        "closing_elo",
        (F.col("closing_elo") - F.col("opening_elo")).alias("elo_change_in_week"),
        "prev_week_closing_elo",
        (F.col("closing_elo") - F.col("prev_week_closing_elo")).alias("elo_change_wow"),
        whole_weeks("week_start_date", "prev_week_start_date").alias("weeks_since_prev_active"),
        F.current_timestamp().alias("_transformed_at"),
    )


def opening_win_rates(games: DataFrame, openings: DataFrame) -> DataFrame:
    """How an opening scores for White, by rating bracket and format.

    The join meets aggregated rows only. Its strategy is left to the size check
    of adaptive execution: broadcast while the dimension is small.
    """
    counted = (
        games.filter(
            F.col("eco_code").isNotNull() & F.col("elo_bracket_white").isNotNull() & F.col("rated")
        )
        .groupBy("eco_code", F.col("elo_bracket_white").alias("elo_bracket"), "time_class")
        .agg(
            _games().alias("games"),
            F.count_if(F.col("outcome") == "1-0").alias("white_wins"),
            F.count_if(F.col("outcome") == "0-1").alias("black_wins"),
            F.count_if("is_draw").alias("draws"),
            F.avg("total_moves").alias("avg_total_moves"),
            share(F.col("termination") == "checkmate").alias("checkmate_rate"),
        )
    )
    names = openings.select("eco_code", "opening_name", "eco_volume")
    games_count = F.col("games")
    return counted.join(names, "eco_code", "left").select(
        "eco_code",
        F.coalesce("opening_name", F.lit("Unknown")).alias("opening_name"),
        "eco_volume",
        "elo_bracket",
        "time_class",
        "games",
        "white_wins",
        "black_wins",
        "draws",
        rate(F.col("white_wins"), games_count).alias("white_win_rate"),
        rate(F.col("black_wins"), games_count).alias("black_win_rate"),
        rate(F.col("draws"), games_count).alias("draw_rate"),
        rate(F.col("white_wins") + 0.5 * F.col("draws"), games_count).alias("white_score_rate"),
        "avg_total_moves",
        "checkmate_rate",
        (games_count >= SIGNIFICANT_GAMES).alias("is_significant_sample"),
        F.current_timestamp().alias("_transformed_at"),
    )


def time_control_meta(games: DataFrame) -> DataFrame:
    """What games of a format and bracket look like. One partial-then-final pass."""
    clocked = ~F.col("is_daily")
    return (
        games.filter(F.col("rated") & F.col("elo_bracket_white").isNotNull())
        .groupBy("time_class", F.col("elo_bracket_white").alias("elo_bracket"))
        .agg(
            _games().alias("games"),
            F.avg("total_moves").alias("avg_total_moves"),
            F.percentile_approx("total_moves", 0.5).alias("median_total_moves"),
            F.percentile_approx("total_moves", 0.9).alias("p90_total_moves"),
            share(F.col("is_draw")).alias("draw_rate"),
            share(~F.col("is_draw")).alias("decisive_rate"),
            share(F.col("termination") == "checkmate").alias("checkmate_rate"),
            share(F.col("termination") == "resignation").alias("resignation_rate"),
            share(F.col("termination") == "timeout").alias("timeout_rate"),
            share(F.col("termination") == "abandonment").alias("abandonment_rate"),
            share(F.col("termination") == "unknown").alias("unknown_termination_rate"),
            F.avg(F.abs(F.col("white_elo") - F.col("black_elo"))).alias("avg_elo_gap"),
            F.avg(F.when(clocked, F.col("base_time_sec"))).alias("avg_base_time_sec"),
            F.avg(F.when(clocked, F.col("increment_sec"))).alias("avg_increment_sec"),
            F.count_if("is_daily").alias("daily_games"),
            F.current_timestamp().alias("_transformed_at"),
        )
    )


def player_cohorts(games: DataFrame, players: DataFrame, as_of: dt.date) -> DataFrame:
    """Sign-up cohorts per format.

    Rows are per (player, format) when they are grouped, and a player has one
    dimension row, so counting rows counts distinct players.
    """
    used = ["game_date", "time_class", "total_moves", "username", "elo", "score"]
    activity = (
        player_game_results(games.filter("rated"), used)
        .filter(F.col("elo").isNotNull())
        .groupBy("username", "time_class")
        .agg(
            _games().alias("games_played"),
            F.avg("score").alias("score_rate"),
            F.avg(F.col("elo").cast("double")).alias("avg_elo"),
            F.max("elo").alias("peak_elo"),
            F.min("game_date").alias("first_game_date"),
            F.max("game_date").alias("last_game_date"),
            F.avg("total_moves").alias("avg_total_moves"),
        )
    )
    cohort = players.filter(F.col("join_cohort_year").isNotNull()).select(
        "username", "join_cohort_year"
    )
    active = F.col("last_game_date") >= F.date_sub(F.lit(as_of), ACTIVE_DAYS)
    return (
        activity.join(cohort, "username")
        .groupBy("join_cohort_year", "time_class")
        .agg(
            _games().alias("cohort_size"),
            F.sum("games_played").alias("total_games"),
            F.avg("games_played").alias("avg_games_per_player"),
            F.percentile_approx("games_played", 0.5).alias("median_games_per_player"),
            F.avg("avg_elo").alias("avg_elo"),
            F.avg("peak_elo").alias("avg_peak_elo"),
            F.percentile_approx(F.round("avg_elo").cast("bigint"), 0.5).alias("median_avg_elo"),
            F.avg("score_rate").alias("avg_score_rate"),
            F.avg("avg_total_moves").alias("avg_total_moves"),
            F.avg(F.datediff("last_game_date", "first_game_date")).alias("avg_active_span_days"),
            F.count_if(active).alias("players_active_last_30d"),
            share(active).alias("active_last_30d_rate"),
        )
        .select(
            "join_cohort_year",
            "time_class",
            "cohort_size",
            "total_games",
            "avg_games_per_player",
            "median_games_per_player",
            "avg_elo",
            "avg_peak_elo",
            "median_avg_elo",
            "avg_score_rate",
            "avg_total_moves",
            (F.lit(as_of.year).cast("bigint") - F.col("join_cohort_year")).alias(
                "cohort_age_years"
            ),
            "avg_active_span_days",
            "players_active_last_30d",
            "active_last_30d_rate",
            (F.col("cohort_size") >= SIGNIFICANT_PLAYERS).alias("is_significant_sample"),
            F.current_timestamp().alias("_transformed_at"),
        )
    )
