"""Second computation of moves, event log, messages and windows."""

from __future__ import annotations

from oracles.archives import RAW_GAMES, _TERMINATION

_SANS = r"""list_filter(
  list_transform(
    list_filter(string_split_regex(regexp_replace({0}, '\{{[^}}]*\}}', ' ', 'g'), '\s+'),
      lambda t: t NOT IN ('1-0', '0-1', '1/2-1/2', '*') AND NOT starts_with(t, '$')),
    lambda t: regexp_replace(t, '^\d+\.(\.\.)?', '')),
  lambda t: t NOT IN ('', '1-0', '0-1', '1/2-1/2', '*'))"""

_CLOCKS = r"regexp_extract_all({0}, '\[%clk\s+([^\]]+)\]', 1)"

# Every replayable game with its half-moves, copies kept apart by a row number.
LOG = (
    RAW_GAMES
    + rf""",
contexts AS (
  SELECT row_number() OVER () AS copy_id,
    nullif(regexp_extract(url, '/(\d+)/?$', 1), '') AS game_id, url AS game_url,
    lower(white_name) AS player_white, lower(black_name) AS player_black, white_elo, black_elo,
    lower(time_class) AS time_class, time_control AS time_control_raw,
    nullif(regexp_extract(pgn, '\[ECO "([^"]+)"\]', 1), '') AS eco_code,
    nullif(replace(regexp_extract(eco, '([^/]+)/?$', 1), '-', ' '), '') AS opening_name,
    CASE WHEN white_result = 'win' THEN '1-0' WHEN black_result = 'win' THEN '0-1'
         ELSE '1/2-1/2' END AS outcome,
    CASE WHEN white_result = 'win' THEN 'white' WHEN black_result = 'win' THEN 'black' END
      AS winner_color,
    {_TERMINATION.format("white_result", "black_result")} AS termination,
    fen AS final_fen, CAST(make_timestamp(end_time * 1000000) AS DATE) AS source_game_date,
    CASE WHEN time_control LIKE '1/%' THEN NULL
         ELSE regexp_extract(time_control, '^(\d+)', 1)::DOUBLE END AS start_clock,
    {_SANS.format(r"split_part(pgn, E'\n\n', 2)")} AS sans,
    {_CLOCKS.format(r"split_part(pgn, E'\n\n', 2)")} AS clocks
  FROM raw_games
  WHERE (rules IS NULL OR rules = 'chess') AND url NOT LIKE '%none'
),
replayed AS (SELECT * FROM contexts WHERE len(sans) > 0),
plies AS (
  SELECT *, unnest(range(1, len(sans) + 1)) AS ply FROM replayed
),
clocked AS (
  SELECT *, sans[ply] AS move_san, (ply + 1) // 2 AS move_number,
    CASE WHEN ply % 2 = 1 THEN 'white' ELSE 'black' END AS color,
    round_even(split_part(clocks[ply], ':', 1)::DOUBLE * 3600
      + split_part(clocks[ply], ':', 2)::DOUBLE * 60
      + split_part(clocks[ply], ':', 3)::DOUBLE, 1) AS clock
  FROM plies
),
observed AS (
  SELECT *,
    last_value(CASE WHEN color = 'white' THEN clock END IGNORE NULLS) OVER w AS white_clock,
    last_value(CASE WHEN color = 'black' THEN clock END IGNORE NULLS) OVER w AS black_clock
  FROM clocked
  WINDOW w AS (PARTITION BY copy_id ORDER BY ply ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
entries AS (
  SELECT copy_id, 0 AS position, 'game_start' AS event_type, NULL::BIGINT AS ply,
    NULL::BIGINT AS move_number, NULL AS color, NULL AS move_san, NULL::DOUBLE AS mover_clock_sec,
    start_clock AS white_clock_sec, start_clock AS black_clock_sec FROM replayed
  UNION ALL
  SELECT copy_id, ply, 'move', ply, move_number, color, move_san, clock, white_clock, black_clock
  FROM observed
  UNION ALL
  SELECT copy_id, len(sans) + 1, 'game_end', NULL, NULL, NULL, NULL, NULL, white_clock, black_clock
  FROM observed WHERE ply = len(sans)
),
log AS (
  SELECT sha256(concat_ws(':', game_id, event_type, ply::VARCHAR)) AS event_id, event_type,
    make_timestamp((1788091200 + game_id::BIGINT % 1800) * 1000000 + position * 7500000)
      AS event_ts,
    game_id, game_url, player_white, player_black, white_elo, black_elo, time_class,
    time_control_raw, eco_code, opening_name, ply, move_number, color, move_san, mover_clock_sec,
    white_clock_sec, black_clock_sec,
    CASE WHEN event_type = 'game_end' THEN outcome END AS outcome,
    CASE WHEN event_type = 'game_end' THEN winner_color END AS winner_color,
    CASE WHEN event_type = 'game_end' THEN termination END AS termination,
    CASE WHEN event_type = 'game_end' THEN (len(sans) + 1) // 2 END AS total_moves,
    CASE WHEN event_type = 'game_end' THEN final_fen END AS final_fen,
    TRUE AS is_simulated, source_game_date, 'replay/0.1' AS producer_version
  FROM entries JOIN replayed USING (copy_id)
)"""
)

UNIQUE = (
    LOG
    + """,
feed AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
                ORDER BY event_ts, white_elo DESC NULLS LAST) AS nth FROM log)
  WHERE nth = 1
)"""
)

_SESSIONS = """
marked AS (
  SELECT *, CASE WHEN event_ts - lag(event_ts) OVER w <= INTERVAL 300 SECOND THEN 0 ELSE 1 END
    AS is_first
  FROM feed WINDOW w AS (PARTITION BY game_id ORDER BY event_ts)
),
sessions AS (
  SELECT *, sum(is_first) OVER (PARTITION BY game_id ORDER BY event_ts) AS nth FROM marked
),
summary AS (
  SELECT min(event_ts) AS window_start, max(event_ts) + INTERVAL 300 SECOND AS window_end,
    game_id,
    first(player_white ORDER BY coalesce(ply, 0), event_ts) AS player_white,
    first(player_black ORDER BY coalesce(ply, 0), event_ts) AS player_black,
    first(time_class ORDER BY coalesce(ply, 0), event_ts) AS time_class,
    first(eco_code ORDER BY coalesce(ply, 0), event_ts) AS eco_code,
    count(*) FILTER (WHERE event_type = 'move') AS moves_in_window,
    min(ply) AS first_ply, max(ply) AS last_ply,
    avg(CASE WHEN previous IS NOT NULL THEN epoch_us(event_ts) - epoch_us(previous) END) / 1e6
      AS gap,
    min(CASE WHEN event_type = 'move' THEN least(white_clock_sec, black_clock_sec) END)
      AS min_clock_sec,
    bool_or(event_type = 'game_end') AS is_finished, max(outcome) AS outcome,
    max(termination) AS termination
  FROM (SELECT *, CASE WHEN event_type = 'move' THEN
            lag(CASE WHEN event_type = 'move' THEN event_ts END) OVER (
              PARTITION BY game_id, nth ORDER BY event_ts) END AS previous
        FROM sessions)
  GROUP BY game_id, nth
),
stats AS (
  SELECT window_start, window_end, 'game_session' AS window_type, game_id, player_white,
    player_black, time_class, eco_code, moves_in_window, first_ply, last_ply,
    round_even(moves_in_window / ((epoch_us(window_end) - epoch_us(window_start)) / 6e7::DOUBLE), 3)
      AS moves_per_minute,
    round_even(gap, 3) AS avg_think_time_sec, min_clock_sec, is_finished, outcome, termination
  FROM summary
)"""

_THROUGHPUT = """
stats AS (
  SELECT date_trunc('minute', event_ts) AS window_start,
    date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end,
    'fixed_metrics' AS window_type, NULL::VARCHAR AS game_id, NULL::VARCHAR AS player_white,
    NULL::VARCHAR AS player_black, coalesce(nullif(time_class, ''), 'unknown') AS time_class,
    NULL::VARCHAR AS eco_code, count(*) FILTER (WHERE event_type = 'move') AS moves_in_window,
    NULL::BIGINT AS first_ply, NULL::BIGINT AS last_ply,
    round_even((count(*) FILTER (WHERE event_type = 'move'))::DOUBLE, 3) AS moves_per_minute,
    NULL::DOUBLE AS avg_think_time_sec,
    min(CASE WHEN event_type = 'move' THEN least(white_clock_sec, black_clock_sec) END)
      AS min_clock_sec,
    bool_or(event_type = 'game_end') AS is_finished, NULL::VARCHAR AS outcome,
    NULL::VARCHAR AS termination
  FROM feed GROUP BY window_start, window_end, 7
)"""


# Which payload an event of the table became, and what is wrong with it.
_KINDS = """
kinds AS (
  SELECT *, event_id % 26 AS kind, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events
),
verdicts AS (
  SELECT *, '{"event_id":"e' || event_id || '","event_ts":"' || iso || '+02:00","game_id":"'
      || user_id || '","event_type":' AS head,
    CASE kind
      WHEN 0 THEN ['not_json', 'not one JSON value']
      WHEN 1 THEN ['not_an_object', 'top level: array']
      WHEN 2 THEN ['field_missing',
        'without value: event_id, event_ts, game_id, ply, move_number, color, move_san']
      WHEN 3 THEN ['value_domain', 'not allowed: event_type = "teleport"']
      WHEN 4 THEN ['field_unknown', 'outside the contract: extra, surprise']
      WHEN 5 THEN ['field_missing', 'without value: ply']
      WHEN 6 THEN ['value_domain', 'not allowed: ply = 0']
      WHEN 7 THEN ['value_type', 'cannot be held: ply = "1"']
      WHEN 8 THEN ['value_domain', 'not allowed: color = "green"']
      WHEN 9 THEN ['field_missing', 'without value: move_san']
      WHEN 10 THEN ['value_domain', 'not allowed: outcome = "win"']
      WHEN 11 THEN ['field_missing', 'without value: termination']
      WHEN 12 THEN ['time_unreadable', 'no ISO 8601 time: event_ts = "yesterday"']
      WHEN 13 THEN ['value_type', 'cannot be held: event_ts = 12']
      WHEN 14 THEN ['not_an_object', 'top level: string']
      WHEN 20 THEN ['value_type', 'cannot be held: white_elo = "abc", black_elo = 1.5']
      WHEN 21 THEN ['value_type', 'cannot be held: source_game_date = "nope"']
      WHEN 22 THEN ['field_missing', 'without value: move_number, move_san; '
        || 'cannot be held: is_simulated = "maybe"; outside the contract: odd; '
        || 'not allowed: color = "green", ply = 0']
      WHEN 23 THEN ['not_json', 'not one JSON value'] END AS verdict
  FROM kinds
)"""

_REJECTED = """
SELECT verdict[1] AS error_type,
  verdict[2] AS error_message, 'm' || event_id AS pubsub_message_id,
  '{"event_id":"m' || event_id || '","game_id":"' || user_id || '"}' AS attributes,
  CASE kind
    WHEN 0 THEN 'not json ' || event_id
    WHEN 1 THEN '[' || event_id || ']'
    WHEN 2 THEN '{"event_type": "move"}'
    WHEN 3 THEN '{"event_id":"' || event_id || '","event_type":"teleport","event_ts":"' || iso
                || '","game_id":"' || user_id || '"}'
    WHEN 4 THEN '{"event_id":"' || event_id || '","event_type":"game_start","event_ts":"' || iso
                || '","game_id":"' || user_id || '","surprise":1,"extra":2}'
    WHEN 5 THEN head || '"move","move_number":1,"color":"white","move_san":"e4"}'
    WHEN 6 THEN head || '"move","ply":0,"move_number":1,"color":"white","move_san":"e4"}'
    WHEN 7 THEN head || '"move","ply":"1","move_number":1,"color":"white","move_san":"e4"}'
    WHEN 8 THEN head || '"move","ply":1,"move_number":1,"color":"green","move_san":"e4"}'
    WHEN 9 THEN head || '"move","ply":1,"move_number":1,"color":"white","move_san":""}'
    WHEN 10 THEN head || '"game_end","outcome":"win","termination":"timeout"}'
    WHEN 11 THEN head || '"game_end","outcome":"1-0"}'
    WHEN 12 THEN '{"event_id":"' || event_id
                || '","event_type":"game_start","event_ts":"yesterday","game_id":"' || user_id || '"}'
    WHEN 13 THEN '{"event_id":"' || event_id
                || '","event_type":"game_start","event_ts":12,"game_id":"' || user_id || '"}'
    WHEN 14 THEN '"' || event_id || '"'
    WHEN 20 THEN head || '"game_start","white_elo":"abc","black_elo":1.5}'
    WHEN 21 THEN head || '"game_start","source_game_date":"nope"}'
    WHEN 22 THEN head || '"move","ply":0,"color":"green","is_simulated":"maybe","odd":[1]}'
    ELSE '{"event_id":"e' || event_id || '","event_type":"game_start","event_ts":"' || iso
                || '+02:00","game_id":"' || user_id || '"} {}' END AS payload
FROM verdicts WHERE verdict IS NOT NULL"""

_ACCEPTED = """
SELECT 'e' || event_id AS event_id,
  CASE WHEN kind = 15 THEN 'game_end' WHEN kind IN (16, 24, 25) THEN 'game_start' ELSE 'move' END
    AS event_type,
  CASE kind WHEN 25 THEN date_trunc('hour', ts) ELSE ts END - INTERVAL 2 HOUR AS event_ts, user_id::VARCHAR AS game_id, NULL::VARCHAR AS game_url,
  NULL::VARCHAR AS player_white, NULL::VARCHAR AS player_black,
  CASE kind WHEN 16 THEN user_id END AS white_elo, NULL::BIGINT AS black_elo,
  NULL::VARCHAR AS time_class, NULL::VARCHAR AS time_control_raw, NULL::VARCHAR AS eco_code,
  NULL::VARCHAR AS opening_name,
  CASE WHEN kind IN (17, 18, 19) THEN user_id + 1 END AS ply,
  CASE WHEN kind IN (17, 18, 19) THEN user_id // 2 + 1 END AS move_number,
  CASE WHEN kind IN (17, 18, 19) THEN 'black' END AS color, CASE WHEN kind IN (17, 18, 19) THEN 'e5' END AS move_san,
  CASE WHEN kind IN (17, 18, 19) THEN value END AS mover_clock_sec,
  NULL::DOUBLE AS white_clock_sec, NULL::DOUBLE AS black_clock_sec,
  CASE kind WHEN 15 THEN '0-1' END AS outcome, NULL::VARCHAR AS winner_color,
  CASE kind WHEN 15 THEN 'resignation' END AS termination, NULL::BIGINT AS total_moves,
  NULL::VARCHAR AS final_fen, NULL::BOOLEAN AS is_simulated, NULL::DATE AS source_game_date,
  NULL::VARCHAR AS producer_version
FROM verdicts WHERE verdict IS NULL"""

# Late: below the highest time of earlier batches less two minutes.
_ENTERED = f"""
accepted AS ({_ACCEPTED}),
placed AS (SELECT *, CAST(substr(event_id, 2) AS BIGINT) % 4 AS batch FROM accepted),
marked AS (
  SELECT *, coalesce(event_ts < (
      SELECT max(event_ts) FROM placed earlier WHERE earlier.batch < placed.batch
    ) - INTERVAL 120 SECOND, FALSE) AS is_late
  FROM placed
)"""

EVENTS = {
    "game_moves": rf"""WITH {RAW_GAMES},
newest AS (
  SELECT * FROM (
    SELECT nullif(regexp_extract(url, '/(\d+)/?$', 1), '') AS game_id,
      split_part(pgn, E'\n\n', 2) AS movetext,
      row_number() OVER (PARTITION BY url ORDER BY _ingested_at DESC, _source_endpoint) AS nth
    FROM raw_games)
  WHERE nth = 1 AND game_id IS NOT NULL
),
lists AS (
  SELECT game_id, {_SANS.format("movetext")} AS sans, {_CLOCKS.format("movetext")} AS clocks
  FROM newest
)
SELECT game_id, ply::INTEGER AS ply, ((ply + 1) // 2)::INTEGER AS move_number,
  CASE WHEN ply % 2 = 1 THEN 'white' ELSE 'black' END AS color, sans[ply] AS san,
  clocks[ply] AS clock
FROM (SELECT *, unnest(range(1, len(sans) + 1)) AS ply FROM lists)""",
    "game_event_log": f"WITH {LOG} SELECT * FROM log",
    "feed_roundtrip": f"""WITH {UNIQUE}
SELECT event_type, time_class, color, count(*) AS events, min(event_ts) AS first_ts,
  max(event_ts) AS last_ts, sum(ply)::BIGINT AS plies, sum(total_moves)::BIGINT AS total_moves,
  round(sum(mover_clock_sec), 2) AS clock_seconds, max(source_game_date) AS last_game_date,
  count(outcome) AS outcomes, min(opening_name) AS first_opening, max(move_san) AS last_san,
  sum(white_elo)::BIGINT AS white_elo, count(DISTINCT game_id) AS games
FROM feed GROUP BY event_type, time_class, color""",
    "game_sessions": f"WITH {UNIQUE},{_SESSIONS} SELECT * FROM stats",
    "feed_throughput": f"WITH {UNIQUE},{_THROUGHPUT} SELECT * FROM stats",
    "streamed_game_sessions": f"WITH {UNIQUE},{_SESSIONS} SELECT * FROM stats",
    "streamed_throughput": f"WITH {UNIQUE},{_THROUGHPUT} SELECT * FROM stats",
    "rerun_throughput": f"WITH {UNIQUE},{_THROUGHPUT} SELECT * FROM stats",
    "ndjson_feed": f"WITH {UNIQUE} SELECT * FROM feed",
    "kept_event_days": f"""WITH {UNIQUE},
later AS (
  SELECT game_id, CAST(event_ts + to_days(CAST(game_id::BIGINT % 60 AS INTEGER)) AS DATE) AS day
  FROM feed
)
SELECT day, count(*) AS events, count(DISTINCT game_id) AS games
FROM later WHERE day >= DATE '2026-10-02' GROUP BY day""",
    "ordered_replay": f"""WITH {UNIQUE}
SELECT game_id, count(*) AS messages, 0::BIGINT AS disordered, min(event_ts) AS first_ts,
  max(event_ts) AS last_ts
FROM feed GROUP BY game_id
UNION ALL
SELECT NULL, count(*), 0, min(event_ts), max(event_ts) FROM feed""",
    "rejected_messages": f"WITH {_KINDS} {_REJECTED}",
    "entered_events": f"WITH {_KINDS},{_ENTERED} SELECT * EXCLUDE (batch) FROM marked",
    "entered_late_events": f"""WITH {_KINDS},{_ENTERED}
SELECT event_id, game_id, event_type, event_ts, event_ts AS window_start, 'LATE' AS pane_info
FROM marked WHERE is_late""",
    "entered_dead_letters": f"WITH {_KINDS} {_REJECTED}",
    "accepted_messages": f"WITH {_KINDS} {_ACCEPTED}",
}
