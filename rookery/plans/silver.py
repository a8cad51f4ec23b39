"""Conformed tables: games, players, openings and the player-grain view."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from rookery import schemas
from rookery.functions import derive, text, vocab
from rookery.operators.labels import most_frequent_label
from rookery.operators.latest import latest_per_key
from rookery.operators.regrain import stack_rows


def in_window(column: str, start: dt.date | None, end: dt.date | None) -> Column:
    """Inclusive date window; an open side is unbounded."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col(column) >= F.lit(start))
    if end is not None:
        condition = condition & (F.col(column) <= F.lit(end))
    return condition


def prune_months(
    raw: DataFrame, start: dt.date | None, end: dt.date | None, slack_months: int = 1
) -> DataFrame:
    """Keep the landing months the window touches (a partition filter).

    A game lands in the month of its archive, which may differ from its UTC
    month; ``slack_months`` widens the range on both sides.
    """
    month_index = F.col("year") * 12 + F.col("month") - 1
    if start is not None:
        raw = raw.filter(month_index >= start.year * 12 + start.month - 1 - slack_months)
    if end is not None:
        raw = raw.filter(month_index <= end.year * 12 + end.month - 1 + slack_months)
    return raw


def clean_games(
    raw: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    slack_months: int = 1,
) -> DataFrame:
    """One conformed row per distinct game of the window.

    All text is parsed before the only shuffle, so the move text (most of the
    bytes) never leaves its map task.
    """
    ended_at = F.timestamp_seconds(F.col("end_time"))
    white_result, black_result = F.lower("white.result"), F.lower("black.result")
    parsed = prune_months(raw, start, end, slack_months).select(
        derive.game_id(F.col("url")).alias("game_id"),
        F.col("uuid").alias("game_uuid"),
        F.col("url").alias("game_url"),
        ended_at.cast("date").alias("game_date"),
        ended_at.alias("ended_at"),
        "rated",
        "rules",
        derive.known_time_class(F.lower("time_class")).alias("time_class"),
        F.col("time_control").alias("time_control_raw"),
        derive.base_seconds(F.col("time_control")).alias("base_time_sec"),
        derive.increment_seconds(F.col("time_control")).alias("increment_sec"),
        derive.is_correspondence(F.col("time_control")).alias("is_daily"),
        F.lower("white.username").alias("player_white"),
        F.lower("black.username").alias("player_black"),
        F.col("white.rating").alias("white_elo"),
        F.col("black.rating").alias("black_elo"),
        derive.outcome(white_result, black_result).alias("outcome"),
        derive.winner_color(white_result, black_result).alias("winner_color"),
        derive.termination(white_result, black_result).alias("termination"),
        derive.eco_code(F.col("pgn")).alias("eco_code"),
        derive.opening_name(F.col("eco")).alias("opening_name"),
        derive.full_moves(derive.movetext(F.col("pgn"))).alias("total_moves"),
        F.col("fen").alias("final_fen"),
        "_ingested_at",
        "_source_endpoint",
    )
    eligible = parsed.filter(
        F.col("game_id").isNotNull()
        & F.col("game_date").isNotNull()
        & (F.col("rules") == vocab.STANDARD_RULES)
    )
    newest = latest_per_key(
        eligible, ["game_id"], [F.desc("_ingested_at"), F.asc("_source_endpoint")]
    )
    return (
        newest.filter(in_window("game_date", start, end))
        .withColumns(
            {
                "elo_bracket_white": derive.elo_bracket(F.col("white_elo")),
                "elo_bracket_black": derive.elo_bracket(F.col("black_elo")),
                "winner_username": derive.winner_username(
                    F.col("winner_color"), F.col("player_white"), F.col("player_black")
                ),
                "is_draw": derive.is_draw(F.col("outcome")),
                "eco_volume": derive.eco_volume(F.col("eco_code")),
                "_transformed_at": F.current_timestamp(),
            }
        )
        .select(*schemas.CLEAN_GAMES.fieldNames())
    )


_SHARED = [
    "game_id",
    "game_date",
    "ended_at",
    "time_class",
    "rated",
    "eco_code",
    "eco_volume",
    "opening_name",
    "total_moves",
    "termination",
    "is_draw",
]


def _side(color: str, other: str, won: str, lost: str) -> dict[str, Column]:
    return {
        "username": F.col(f"player_{color}"),
        "color": F.lit(color),
        "elo": F.col(f"{color}_elo"),
        "elo_bracket": F.col(f"elo_bracket_{color}"),
        "opponent_username": F.col(f"player_{other}"),
        "opponent_elo": F.col(f"{other}_elo"),
        "score": derive.score(F.col("outcome"), won, lost),
        "result": derive.result(F.col("outcome"), won, lost),
    }


def player_game_results(games: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per game and player.

    ``columns`` names what the caller uses, so that the scan below reads only
    the source columns behind them. Filters on game-level columns pass through
    to the scan.
    """
    white = _side("white", "black", vocab.WHITE_WON, vocab.BLACK_WON)
    black = _side("black", "white", vocab.BLACK_WON, vocab.WHITE_WON)
    columns = columns or [*_SHARED, *white]
    sides = [{n: side[n] for n in side if n in columns} for side in (white, black)]
    return stack_rows(games, [c for c in _SHARED if c in columns], sides).select(*columns)


def openings_dim(games: DataFrame) -> DataFrame:
    """One row per opening code with its commonest name."""
    return most_frequent_label(games, "eco_code", "opening_name").select(
        "eco_code",
        "opening_name",
        derive.eco_volume(F.col("eco_code")).alias("eco_volume"),
        derive.eco_volume_code(F.col("eco_code")).alias("eco_volume_code"),
        F.col("total_rows").alias("games_observed"),
        F.col("label_variants").alias("name_variant_count"),
        F.current_timestamp().alias("_transformed_at"),
    )


_FORMATS = ["rapid", "blitz", "bullet"]


def _profiles(raw: DataFrame) -> DataFrame:
    named = raw.filter(F.col("username").isNotNull()).select(
        F.lower("username").alias("username"),
        "player_id",
        F.col("name").alias("display_name"),
        "title",
        F.col("status").alias("membership_status"),
        text.last_segment(F.col("country")).alias("country_code"),
        "followers",
        F.timestamp_seconds("joined").cast("date").alias("joined_date"),
        F.timestamp_seconds("last_online").alias("last_online_at"),
        F.coalesce("is_streamer", F.lit(False)).alias("is_streamer"),
        F.col("url").alias("profile_url"),
        "_ingested_at",
        "_source_endpoint",
    )
    newest = [F.desc("_ingested_at"), F.asc("_source_endpoint"), F.desc("player_id")]
    return latest_per_key(named, ["username"], newest).drop("_source_endpoint")


def _career(kind: str) -> Column:
    wins = [F.coalesce(f"chess_{f}.record.{kind}", F.lit(0)) for f in _FORMATS]
    return wins[0] + wins[1] + wins[2]


def _stats(raw: DataFrame) -> DataFrame:
    named = raw.filter(F.col("username").isNotNull()).select(
        F.lower("username").alias("username"),
        *[F.col(f"chess_{f}.last.rating").alias(f"{f}_rating") for f in _FORMATS],
        *[F.col(f"chess_{f}.best.rating").alias(f"{f}_best_rating") for f in _FORMATS],
        _career("win").alias("career_wins"),
        _career("loss").alias("career_losses"),
        _career("draw").alias("career_draws"),
        F.col("fide").alias("fide_rating"),
        "_ingested_at",
        "_source_endpoint",
    )
    newest = [F.desc("_ingested_at"), F.asc("_source_endpoint"), F.desc("fide_rating")]
    return latest_per_key(named, ["username"], newest).drop("_ingested_at", "_source_endpoint")


def _titles(raw: DataFrame) -> DataFrame:
    return raw.groupBy(F.lower("username").alias("username")).agg(F.min("title").alias("titled_as"))


def dim_players(profiles: DataFrame, stats: DataFrame, titled: DataFrame) -> DataFrame:
    """Current state of every player with a profile.

    All three inputs are unique per username before they meet, and all are
    partitioned by it, so the joins reuse the shuffles of the deduplication.
    """
    joined = (
        _profiles(profiles).join(_stats(stats), "username", "left").join(
            _titles(titled), "username", "left"
        )
    )
    played = F.col("career_wins") + F.col("career_losses") + F.col("career_draws")
    best_live = F.greatest(*[F.coalesce(f"{f}_rating", F.lit(0)) for f in _FORMATS])
    return joined.select(
        "username",
        "player_id",
        "display_name",
        F.coalesce("title", "titled_as").alias("title"),
        F.col("titled_as").isNotNull().alias("is_titled"),
        "membership_status",
        "country_code",
        "followers",
        "joined_date",
        F.year("joined_date").cast("bigint").alias("join_cohort_year"),
        "last_online_at",
        "is_streamer",
        "profile_url",
        *[f"{f}_rating" for f in _FORMATS],
        *[f"{f}_best_rating" for f in _FORMATS],
        best_live.alias("peak_current_rating"),
        "fide_rating",
        "career_wins",
        "career_losses",
        "career_draws",
        text.rate(F.col("career_wins"), played).alias("career_win_rate"),
        "_ingested_at",
        F.current_timestamp().alias("_transformed_at"),
    )
