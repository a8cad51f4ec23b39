"""Fixed values of the domain, defined once for the batch and the stream side.

Everything in the upper half must equal the published vocabulary of the data
source; the builders below turn the values into Column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------

STANDARD_RULES = "chess"

TERMINATION_BY_REASON = {
    "checkmated": "checkmate",
    "resigned": "resignation",
    "timeout": "timeout",
    "abandoned": "abandonment",
    "agreed": "draw_agreed",
    "repetition": "draw_repetition",
    "stalemate": "draw_stalemate",
    "insufficient": "draw_insufficient_material",
    "50move": "draw_50_move",
    "timevsinsufficient": "draw_timeout_vs_insufficient",
    "kingofthehill": "variant_objective",
    "threecheck": "variant_objective",
    "bughousepartnerlose": "variant_partner_lost",
}

DRAW_TERMINATIONS = [
    "draw_agreed",
    "draw_repetition",
    "draw_stalemate",
    "draw_insufficient_material",
    "draw_50_move",
    "draw_timeout_vs_insufficient",
]

# Label and the first rating above the bracket (None = open end).
ELO_BRACKETS = [
    ("u2000", 2000),
    ("2000_2199", 2200),
    ("2200_2399", 2400),
    ("2400_2599", 2600),
    ("2600_2799", 2800),
    ("2800_plus", None),
]

ECO_VOLUMES = {
    "A": "Flank openings",
    "B": "Semi-open games (excl. French)",
    "C": "Open games and French",
    "D": "Closed and semi-closed games",
    "E": "Indian defences",
}

TIME_CLASSES = ["bullet", "blitz", "rapid", "daily"]

WHITE_WON, BLACK_WON, DRAWN = "1-0", "0-1", "1/2-1/2"
OUTCOMES = [WHITE_WON, BLACK_WON, DRAWN]
RESULT_TOKENS = [*OUTCOMES, "*"]

GAME_START, MOVE, GAME_END = "game_start", "move", "game_end"
EVENT_TYPES = [GAME_START, MOVE, GAME_END]

# --- builders ---------------------------------------------------------------


def lookup(key: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Translate ``key`` through a fixed table; unknown keys give ``default``."""
    literal = F.create_map(*[F.lit(part) for pair in table.items() for part in pair])
    found = literal[key]
    return found if default is None else F.coalesce(found, F.lit(default))


def bracket(value: Column, brackets: list[tuple[str, int | None]] = ELO_BRACKETS) -> Column:
    """Label of the half-open range ``value`` falls in; NULL stays NULL."""
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for label, upper in brackets:
        chain = chain.otherwise(label) if upper is None else chain.when(value < upper, label)
    return chain
