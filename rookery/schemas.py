"""Explicit schemas of every table and message. Nothing is inferred.

Fixed values: column names, their order and their types are those of the data that is read
and written.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "STRING": StringType(),
    "BIGINT": LongType(),
    "INT": IntegerType(),
    "DOUBLE": DoubleType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
    "BINARY": BinaryType(),
}


def _schema(columns: str, **nested: DataType) -> StructType:
    """Schema from ``name TYPE`` pairs; ``nested`` names further types."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, nested.get(kind) or _TYPES[kind])
    return schema


_SIDE = _schema("username STRING, rating BIGINT, result STRING, uuid STRING, @id STRING")
_FORMAT = _schema(
    "last RATED, best RATED, record RECORD",
    RATED=_schema("rating BIGINT"),
    RECORD=_schema("win BIGINT, loss BIGINT, draw BIGINT"),
)
_LINEAGE = "_ingested_at TIMESTAMP, _source_endpoint STRING"

# --- landed data ------------------------------------------------------------

RAW_GAMES = _schema(
    "url STRING, uuid STRING, pgn STRING, time_control STRING, time_class STRING, rules STRING,"
    " rated BOOLEAN, end_time BIGINT, fen STRING, eco STRING, white SIDE, black SIDE,"
    f" {_LINEAGE}, year INT, month INT",
    SIDE=_SIDE,
)
RAW_PROFILES = _schema(
    "username STRING, player_id BIGINT, name STRING, title STRING, status STRING,"
    " country STRING, followers BIGINT, joined BIGINT, last_online BIGINT,"
    f" is_streamer BOOLEAN, url STRING, {_LINEAGE}"
)
RAW_STATS = _schema(
    "username STRING, fide BIGINT, chess_rapid FORMAT, chess_blitz FORMAT,"
    f" chess_bullet FORMAT, {_LINEAGE}",
    FORMAT=_FORMAT,
)
RAW_TITLED = _schema(f"username STRING, title STRING, {_LINEAGE}")

# --- conformed tables -------------------------------------------------------

CLEAN_GAMES = _schema(
    "game_id STRING, game_uuid STRING, game_url STRING, game_date DATE, ended_at TIMESTAMP,"
    " rated BOOLEAN, rules STRING, time_class STRING, time_control_raw STRING,"
    " base_time_sec BIGINT, increment_sec BIGINT, is_daily BOOLEAN, player_white STRING,"
    " player_black STRING, white_elo BIGINT, black_elo BIGINT, elo_bracket_white STRING,"
    " elo_bracket_black STRING, outcome STRING, winner_color STRING, winner_username STRING,"
    " termination STRING, is_draw BOOLEAN, eco_code STRING, eco_volume STRING,"
    " opening_name STRING, total_moves BIGINT, final_fen STRING, _ingested_at TIMESTAMP,"
    " _transformed_at TIMESTAMP, _source_endpoint STRING"
)

# --- event contract: 28 fields, closed and ordered ---------------------------

_EVENT = (
    "event_id STRING, event_type STRING, event_ts TIMESTAMP, game_id STRING, game_url STRING,"
    " player_white STRING, player_black STRING, white_elo BIGINT, black_elo BIGINT,"
    " time_class STRING, time_control_raw STRING, eco_code STRING, opening_name STRING,"
    " ply BIGINT, move_number BIGINT, color STRING, move_san STRING, mover_clock_sec DOUBLE,"
    " white_clock_sec DOUBLE, black_clock_sec DOUBLE, outcome STRING, winner_color STRING,"
    " termination STRING, total_moves BIGINT, final_fen STRING, is_simulated BOOLEAN,"
    " source_game_date DATE, producer_version STRING"
)
EVENT = _schema(_EVENT)
# An accepted event, when it came in, and whether its window had closed.
ACCEPTED = _schema(f"{_EVENT}, received_at TIMESTAMP, is_late BOOLEAN")
MESSAGE = _schema(
    "data BINARY, attributes ATTRIBUTES", ATTRIBUTES=MapType(StringType(), StringType())
)
LIVE_STATS = _schema(
    "window_start TIMESTAMP, window_end TIMESTAMP, window_type STRING, game_id STRING,"
    " player_white STRING, player_black STRING, time_class STRING, eco_code STRING,"
    " moves_in_window BIGINT, first_ply BIGINT, last_ply BIGINT, moves_per_minute DOUBLE,"
    " avg_think_time_sec DOUBLE, min_clock_sec DOUBLE, is_finished BOOLEAN, outcome STRING,"
    " termination STRING, emitted_at TIMESTAMP"
)
LATE_EVENTS = _schema(
    "event_id STRING, game_id STRING, event_type STRING, event_ts TIMESTAMP,"
    " received_at TIMESTAMP, lateness_sec DOUBLE, window_start TIMESTAMP, pane_info STRING,"
    " payload STRING"
)
DLQ_EVENTS = _schema(
    "received_at TIMESTAMP, error_type STRING, error_message STRING, pubsub_message_id STRING,"
    " attributes STRING, payload STRING, pipeline_version STRING"
)

# --- operations -------------------------------------------------------------

RUN_LOG = _schema(
    "run_id STRING, dag_id STRING, task_id STRING, layer STRING, target_table STRING,"
    " status STRING, window_start DATE, window_end DATE, rows_written BIGINT,"
    " bytes_processed BIGINT, duration_sec DOUBLE, error_message STRING, started_at TIMESTAMP,"
    " finished_at TIMESTAMP, logged_at TIMESTAMP"
)
DQ_RESULTS = _schema(
    "run_id STRING, checked_at TIMESTAMP, check_name STRING, target_table STRING,"
    " severity STRING, failed_rows BIGINT, total_rows BIGINT, failed_pct DOUBLE,"
    " threshold_pct DOUBLE, passed BOOLEAN, detail STRING, window_start DATE, window_end DATE"
)
