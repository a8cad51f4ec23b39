"""The data-quality checks of the game table.

Measuring never fails a run; :func:`rookery.operators.checks.gate` decides.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from rookery import schemas
from rookery.functions import derive, vocab
from rookery.operators.checks import Check, duplicate_excess, measure
from rookery.plans.silver import in_window

# Fixed limits of the checks.
LOWEST_ELO, HIGHEST_ELO = 100, 3600
MOST_MOVES = 500


def game_checks(as_of: dt.date) -> list[Check]:
    col, failed = F.col, F.count_if
    return [
        Check("game_id_not_null", "error", failed(col("game_id").isNull()), 0.0,
              "every game needs its natural key"),
        Check("game_id_unique", "error", col("duplicate_rows"), 0.0,
              "a game may appear once", from_side=True),
        Check("game_date_not_null", "error", failed(col("game_date").isNull()), 0.0,
              "the partition column must be set"),
        Check("players_not_null", "error",
              failed(col("player_white").isNull() | col("player_black").isNull()), 0.0,
              "both players must be known"),
        Check("elo_in_range", "error",
              failed(~col("white_elo").between(LOWEST_ELO, HIGHEST_ELO)
                     | ~col("black_elo").between(LOWEST_ELO, HIGHEST_ELO)), 0.1,
              f"ratings lie between {LOWEST_ELO} and {HIGHEST_ELO}"),
        Check("outcome_valid", "error", failed(~col("outcome").isin(vocab.OUTCOMES)), 0.0,
              "the outcome is one of three"),
        Check("no_future_dates", "error", failed(col("game_date") > F.lit(as_of)), 0.0,
              "a game cannot end after today"),
        Check("total_moves_positive", "error",
              failed(col("total_moves").isNull() | (col("total_moves") <= 0)), 0.5,
              "a game without counted moves was not read properly"),
        Check("winner_present_when_decisive", "error",
              failed(col("winner_color").isNull() & (col("outcome") != vocab.DRAWN)), 0.0,
              "a decided game names its winner"),
        Check("decisive_not_draw_terminated", "error",
              failed(~col("is_draw") & col("termination").startswith("draw_")), 0.0,
              "a decided game cannot end by a draw reason"),
        Check("no_self_play", "error", failed(col("player_white") == col("player_black")), 0.0,
              "the players differ"),
        Check("rows_present", "error",
              F.when(F.count(F.lit(1)) == 0, 1).otherwise(0), 0.0,
              "the window holds games", at_least_one=True),
        Check("termination_mapped", "warn", failed(col("termination") == "unknown"), 1.0,
              "a result code is missing from the vocabulary"),
        Check("draw_reason_mapped", "warn",
              failed(col("is_draw") & ~derive.is_draw_termination(col("termination"))), 1.0,
              "a draw reason is missing from the vocabulary"),
        Check("time_class_known", "warn", failed(col("time_class") == "unknown"), 1.0,
              "a format is missing from the vocabulary"),
        Check("total_moves_plausible", "warn", failed(col("total_moves") > MOST_MOVES), 0.1,
              f"no more than {MOST_MOVES} moves are expected"),
        Check("eco_code_present", "warn", failed(col("eco_code").isNull()), 5.0,
              "opening models leave games without a code out"),
    ]


def dq_results(
    games: DataFrame,
    run_id: str,
    start: dt.date,
    end: dt.date,
    as_of: dt.date,
    target: str = "silver.clean_games",
) -> DataFrame:
    """One row per check for a run's window."""
    scoped = games.filter(in_window("game_date", start, end))
    measured = measure(scoped, game_checks(as_of), side=duplicate_excess(scoped, "game_id"))
    return measured.withColumns(
        {
            "run_id": F.lit(run_id),
            "checked_at": F.current_timestamp(),
            "target_table": F.lit(target),
            "window_start": F.lit(start),
            "window_end": F.lit(end),
        }
    ).select(*schemas.DQ_RESULTS.fieldNames())
