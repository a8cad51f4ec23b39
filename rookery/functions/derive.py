"""Domain derivations as Column functions.

Each function takes and returns Columns, so every model that uses one compiles
to built-in expressions. Patterns close with ``\\z`` (the very end of the text):
a bare ``$`` would also accept a trailing line break.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rookery.functions import text, vocab

COMMENT = r"\{[^}]*+\}"


def game_id(url: Column) -> Column:
    """Natural key: the number that ends the game URL."""
    return text.first_group(url, r"/(\d+)/?\z")


def movetext(pgn: Column) -> Column:
    """Everything after the first blank line, without the header block.

    Headers hold dates such as ``2026.08.15``, which look like move numbers.
    """
    return text.first_group(pgn, r"(?s)\n\s*\n(.*)\z")


def eco_code(pgn: Column) -> Column:
    return text.first_group(pgn, r'\[ECO "([^"]+)"\]')


def header_tags(pgn: Column) -> Column:
    """All header tags as a map; the last of a repeated tag wins."""
    pattern = r'(?m)^\[(\w+)\s+"(.*)"\]\s*$'
    block = F.regexp_extract(F.trim(pgn), r"(?s)\A(.*?)(?:\n\s*\n|\z)", 1)
    names, values = text.all_groups(block, pattern, 1), text.all_groups(block, pattern, 2)
    pairs = F.filter(
        F.arrays_zip(names.alias("key"), values.alias("value")),
        lambda pair, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), pair["key"]),
    )
    return F.map_from_entries(pairs)


def base_seconds(time_control: Column) -> Column:
    """Base clock; seconds per move for correspondence controls (``1/N``)."""
    return text.to_long(text.first_group(time_control, r"^(?:1/)?(\d+)"))


def increment_seconds(time_control: Column) -> Column:
    return text.to_long(F.coalesce(text.first_group(time_control, r"\+(\d+)\z"), F.lit("0")))


def is_correspondence(time_control: Column) -> Column:
    return F.startswith(time_control, F.lit("1/"))


def full_moves(moves: Column) -> Column:
    """Highest move number. Comments go first: a clock holds digit-dot text."""
    return text.greatest_number(F.regexp_replace(moves, COMMENT, " "), r"(\d++)\.")


def opening_name(eco_url: Column) -> Column:
    slug = F.replace(text.last_segment(eco_url), F.lit("-"), F.lit(" "))
    return text.blank_to_null(slug)


def eco_volume_code(code: Column) -> Column:
    return F.upper(F.substring(code, 1, 1))


def eco_volume(code: Column) -> Column:
    return vocab.lookup(eco_volume_code(code), vocab.ECO_VOLUMES)


def known_time_class(time_class: Column) -> Column:
    return F.when(time_class.isin(vocab.TIME_CLASSES), time_class).otherwise("unknown")


def outcome(white_result: Column, black_result: Column) -> Column:
    return (
        F.when(white_result == "win", vocab.WHITE_WON)
        .when(black_result == "win", vocab.BLACK_WON)
        .otherwise(vocab.DRAWN)
    )


def winner_color(white_result: Column, black_result: Column) -> Column:
    return F.when(white_result == "win", "white").when(black_result == "win", "black")


def termination(white_result: Column, black_result: Column) -> Column:
    """Why the game ended. The reason sits on the side that did not win."""
    reason = F.when(white_result == "win", black_result).otherwise(white_result)
    return vocab.lookup(F.coalesce(reason, F.lit("")), vocab.TERMINATION_BY_REASON, "unknown")


def elo_bracket(elo: Column) -> Column:
    return vocab.bracket(elo)


def winner_username(color: Column, white: Column, black: Column) -> Column:
    return F.when(color == "white", white).when(color == "black", black)


def is_draw(game_outcome: Column) -> Column:
    """From the outcome alone, so that an unmapped draw reason is still a draw."""
    return game_outcome == vocab.DRAWN


def is_draw_termination(value: Column) -> Column:
    return value.isin(vocab.DRAW_TERMINATIONS)


def score(game_outcome: Column, won: str, lost: str) -> Column:
    return F.when(game_outcome == won, 1.0).when(game_outcome == lost, 0.0).otherwise(0.5)


def result(game_outcome: Column, won: str, lost: str) -> Column:
    return F.when(game_outcome == won, "win").when(game_outcome == lost, "loss").otherwise("draw")


def starting_clock(base: Column, time_control: Column) -> Column:
    """Clock of both sides before move 1; unknown for correspondence games."""
    return F.when(
        ~F.coalesce(is_correspondence(time_control), F.lit(False)), base.cast("double")
    )


def clock_seconds(clock: Column) -> Column:
    """``H:MM:SS.f`` (or fewer parts) in seconds; unreadable text gives NULL."""
    parts = F.transform(F.split(F.trim(clock), ":"), lambda part: part.try_cast("double"))
    return F.bround(F.aggregate(parts, F.lit(0.0), lambda total, part: total * 60 + part), 1)
