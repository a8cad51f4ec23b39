"""Second computation of the conformed tables and marts."""

from __future__ import annotations

# The derived archives, written again in this dialect.
RAW_GAMES = r"""
keys AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_orderpriority[1] AS f,
         788918400 + (epoch(o_orderdate)::BIGINT - 788918400) // 691200 * 86400 AS placed
  FROM orders
),
played AS (
  SELECT *, placed + (k * 7919) % 86400 AS ended,
    CASE WHEN s = 'P'
      THEN ['agreed', 'repetition', 'stalemate', 'insufficient', '50move',
            'timevsinsufficient', 'newdraw'][(k % 7) + 1]
      ELSE ['checkmated', 'resigned', 'timeout', 'abandoned', 'mystery'][(k % 5) + 1]
    END AS reason,
    CASE s WHEN 'F' THEN '1-0' WHEN 'O' THEN '0-1' ELSE '1/2-1/2' END AS token
  FROM keys
),
texts AS (
  SELECT *,
    trim(array_to_string(list_transform(range(1, (k % 61) + 1), lambda p:
      CASE WHEN p % 2 = 1 THEN ((p + 1) // 2)::VARCHAR || '. '
           WHEN k % 3 = 0 THEN (p // 2)::VARCHAR || '... ' ELSE '' END
      || 'abcdefgh'[((k + p) % 8) + 1] || (p % 8 + 1)::VARCHAR
      || CASE WHEN k % 3 = 0 AND (k % 12 <> 0 OR p <= (k % 61) // 2)
           THEN ' {[%clk 0:0' || (9 - p // 8)::VARCHAR || ':'
                || lpad((59 - p % 60)::VARCHAR, 2, '0') || '.' || (p % 10)::VARCHAR || ']}'
           ELSE '' END), ' ') || ' ' || token) AS movetext
  FROM played
),
raw_games AS (
  SELECT
    CASE WHEN k % 211 = 0 THEN 'https://games.example.org/live/none'
         ELSE 'https://games.example.org/live/' || (k + 1) || CASE WHEN k % 97 = 0 THEN '/' ELSE '' END
    END AS url,
    'g-' || k AS uuid,
    E'[Event "Live"]\n[Date "2026.08.15"]\n'
      || CASE WHEN k % 31 = 0 THEN ''
              ELSE '[ECO "' || 'ABCDE'[(k % 5) + 1] || lpad((k % 20)::VARCHAR, 2, '0') || E'"]\n' END
      || CASE WHEN k % 307 = 0 THEN '' ELSE E'\n' || movetext || E'\n' END AS pgn,
    CASE f WHEN '1' THEN CASE WHEN k % 2 = 0 THEN '60' ELSE '60+1' END WHEN '2' THEN '180+2'
           WHEN '3' THEN '600' WHEN '4' THEN '1/259200' ELSE '900+10' END AS time_control,
    CASE f WHEN '1' THEN 'Bullet' WHEN '2' THEN 'blitz' WHEN '3' THEN 'Rapid'
           WHEN '4' THEN 'daily' ELSE 'puzzle' END AS time_class,
    CASE WHEN k % 53 = 5 THEN NULL WHEN k % 29 = 3 THEN 'threecheck' ELSE 'chess' END AS rules,
    CASE WHEN k % 101 = 1 THEN NULL ELSE k % 10 <> 0 END AS rated,
    CASE WHEN k % 503 = 1 THEN NULL ELSE ended END AS end_time,
    'fen-' || k AS fen,
    CASE WHEN k % 47 = 0 THEN NULL
         ELSE 'https://games.example.org/openings/Opening-' || (k % 20) || '-Line-'
              || ((k // 20) % 3) || CASE WHEN k % 6 = 0 THEN '/' ELSE '' END END AS eco,
    'Player' || c AS white_name,
    CASE WHEN k % 113 = 7 THEN NULL ELSE 1500 + (k * 37 + c) % 1500 + copy END AS white_elo,
    CASE WHEN s = 'F' THEN 'win' ELSE reason END AS white_result,
    CASE WHEN k % 601 = 2 THEN NULL WHEN k % 401 = 0 THEN 'PLAYER' || c
         ELSE 'PLAYER' || (c + 1 + k % 7) END AS black_name,
    1500 + (k * 53 + c * 3) % 1500 AS black_elo,
    CASE WHEN s = 'O' THEN 'win' ELSE reason END AS black_result,
    make_timestamp((placed + 2592000 + CASE WHEN k % 9 = 0 THEN 0 ELSE copy * 3600 END)
                   * 1000000) AS _ingested_at,
    'player/' || CASE copy WHEN 0 THEN 'p' ELSE 'a' END || c || '/games' AS _source_endpoint,
    year(make_timestamp(ended * 1000000)) AS year, month(make_timestamp(ended * 1000000)) AS month
  FROM texts, range(2) AS copies(copy)
  WHERE copy = 0 OR k % 3 = 0
)"""

# Labels and codes of rating brackets, opening volumes and terminations.
_BRACKET = """CASE WHEN {0} IS NULL THEN NULL WHEN {0} >= 2800 THEN '2800_plus'
  WHEN {0} >= 2600 THEN '2600_2799' WHEN {0} >= 2400 THEN '2400_2599'
  WHEN {0} >= 2200 THEN '2200_2399' WHEN {0} >= 2000 THEN '2000_2199' ELSE 'u2000' END"""

_VOLUME = """CASE upper({0}[1]) WHEN 'A' THEN 'Flank openings'
  WHEN 'B' THEN 'Semi-open games (excl. French)' WHEN 'C' THEN 'Open games and French'
  WHEN 'D' THEN 'Closed and semi-closed games' WHEN 'E' THEN 'Indian defences' END"""

_TERMINATION = """CASE coalesce(CASE WHEN {0} = 'win' THEN {1} ELSE {0} END, '')
  WHEN 'checkmated' THEN 'checkmate' WHEN 'resigned' THEN 'resignation'
  WHEN 'timeout' THEN 'timeout' WHEN 'abandoned' THEN 'abandonment'
  WHEN 'agreed' THEN 'draw_agreed' WHEN 'repetition' THEN 'draw_repetition'
  WHEN 'stalemate' THEN 'draw_stalemate' WHEN 'insufficient' THEN 'draw_insufficient_material'
  WHEN '50move' THEN 'draw_50_move' WHEN 'timevsinsufficient' THEN 'draw_timeout_vs_insufficient'
  ELSE 'unknown' END"""


def clean_ctes(landed: str = "TRUE", window: str = "TRUE") -> str:
    """The conformed games, from a landing-month filter and a date filter."""
    return (
        RAW_GAMES
        + rf""",
parsed AS (
  SELECT
    nullif(regexp_extract(url, '/(\d+)/?$', 1), '') AS game_id, uuid AS game_uuid,
    url AS game_url, CAST(make_timestamp(end_time * 1000000) AS DATE) AS game_date,
    make_timestamp(end_time * 1000000) AS ended_at, rated, rules,
    CASE WHEN lower(time_class) IN ('bullet', 'blitz', 'rapid', 'daily') THEN lower(time_class)
         ELSE 'unknown' END AS time_class,
    time_control AS time_control_raw,
    CAST(nullif(regexp_extract(time_control, '^(?:1/)?(\d+)', 1), '') AS BIGINT) AS base_time_sec,
    coalesce(CAST(nullif(regexp_extract(time_control, '\+(\d+)$', 1), '') AS BIGINT), 0)
      AS increment_sec,
    time_control LIKE '1/%' AS is_daily,
    lower(white_name) AS player_white, lower(black_name) AS player_black,
    white_elo, black_elo,
    {_BRACKET.format("white_elo")} AS elo_bracket_white,
    {_BRACKET.format("black_elo")} AS elo_bracket_black,
    CASE WHEN white_result = 'win' THEN '1-0' WHEN black_result = 'win' THEN '0-1'
         ELSE '1/2-1/2' END AS outcome,
    CASE WHEN white_result = 'win' THEN 'white' WHEN black_result = 'win' THEN 'black' END
      AS winner_color,
    CASE WHEN white_result = 'win' THEN lower(white_name)
         WHEN black_result = 'win' THEN lower(black_name) END AS winner_username,
    {_TERMINATION.format("white_result", "black_result")} AS termination,
    NOT (white_result = 'win' OR black_result = 'win') AS is_draw,
    nullif(regexp_extract(pgn, '\[ECO "([^"]+)"\]', 1), '') AS eco_code,
    nullif(replace(regexp_extract(eco, '([^/]+)/?$', 1), '-', ' '), '') AS opening_name,
    list_max(list_transform(
      regexp_extract_all(regexp_replace(split_part(pgn, E'\n\n', 2), '\{{[^}}]*\}}', ' ', 'g'),
                         '(\d+)\.', 1),
      lambda n: n::BIGINT)) AS total_moves,
    fen AS final_fen, _ingested_at, _source_endpoint
  FROM raw_games
  WHERE {landed}
),
games AS (
  SELECT game_id, game_uuid, game_url, game_date, ended_at, rated, rules, time_class,
    time_control_raw, base_time_sec, increment_sec, is_daily, player_white, player_black,
    white_elo, black_elo, elo_bracket_white, elo_bracket_black, outcome, winner_color,
    winner_username, termination, is_draw, eco_code,
    {_VOLUME.format("eco_code")} AS eco_volume,
    opening_name, total_moves, final_fen, _ingested_at, _source_endpoint
  FROM (
    SELECT *, row_number() OVER (PARTITION BY game_id
                ORDER BY _ingested_at DESC NULLS LAST, _source_endpoint NULLS FIRST) AS nth
    FROM parsed
    WHERE game_id IS NOT NULL AND game_date IS NOT NULL AND rules = 'chess'
  )
  WHERE nth = 1 AND {window}
)"""
    )


GAMES = clean_ctes()

RESULTS = (
    GAMES
    + """,
results AS (
  SELECT game_id, game_date, ended_at, time_class, rated, eco_code, eco_volume, opening_name,
    total_moves, termination, is_draw, player_white AS username, 'white' AS color,
    white_elo AS elo, elo_bracket_white AS elo_bracket, player_black AS opponent_username,
    black_elo AS opponent_elo,
    CASE outcome WHEN '1-0' THEN 1.0 WHEN '0-1' THEN 0.0 ELSE 0.5 END::DOUBLE AS score,
    CASE outcome WHEN '1-0' THEN 'win' WHEN '0-1' THEN 'loss' ELSE 'draw' END AS result
  FROM games
  UNION ALL
  SELECT game_id, game_date, ended_at, time_class, rated, eco_code, eco_volume, opening_name,
    total_moves, termination, is_draw, player_black, 'black', black_elo, elo_bracket_black,
    player_white, white_elo,
    CASE outcome WHEN '0-1' THEN 1.0 WHEN '1-0' THEN 0.0 ELSE 0.5 END::DOUBLE,
    CASE outcome WHEN '0-1' THEN 'win' WHEN '1-0' THEN 'loss' ELSE 'draw' END
  FROM games
)"""
)

OPENINGS = f""",
openings AS (
  SELECT eco_code, opening_name, {_VOLUME.format("eco_code")} AS eco_volume,
    upper(eco_code[1]) AS eco_volume_code, total::BIGINT AS games_observed,
    variants AS name_variant_count
  FROM (
    SELECT eco_code, opening_name, sum(n) OVER (PARTITION BY eco_code) AS total,
      count(*) OVER (PARTITION BY eco_code) AS variants,
      row_number() OVER (PARTITION BY eco_code ORDER BY n DESC, opening_name) AS nth
    FROM (SELECT eco_code, opening_name, count(*) AS n FROM games
          WHERE eco_code IS NOT NULL AND opening_name IS NOT NULL GROUP BY ALL)
  )
  WHERE nth = 1
)"""


def _record(shift: int, kind: str, missing: str) -> str:
    value = {
        "win": f"(c * {shift}) % 97",
        "loss": f"(c + {shift}) % 89",
        "draw": f"c % {shift}",
    }[kind]
    return f"CASE WHEN c % 13 = 0 OR {missing} THEN 0 ELSE {value} END"


_FORMATS = {"rapid": (11, "FALSE"), "blitz": (17, "c % 5 = 1"), "bullet": (23, "c % 3 = 0")}


def _ratings(kind: str) -> str:
    value = {
        "rating": "1400 + (c * {0}) % 1400 + copy",
        "best_rating": "1500 + (c * {0}) % 1400",
    }[kind]
    return ", ".join(
        f"CASE WHEN {missing} THEN NULL ELSE {value.format(shift)} END AS {name}_{kind}"
        for name, (shift, missing) in _FORMATS.items()
    )


def _career(kind: str) -> str:
    return " + ".join(_record(shift, kind, missing) for shift, missing in _FORMATS.values())


PLAYERS = f"""
profiles AS (
  SELECT c_custkey AS c, 'player' || c_custkey AS username, c_custkey + 1000 AS player_id,
    c_name AS display_name, CASE WHEN c_custkey % 18 = 0 THEN 'GM' END AS title,
    lower(c_mktsegment) AS membership_status, 'N' || c_nationkey AS country_code,
    (c_custkey * 7) % 1000 + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS followers,
    CAST(make_timestamp((631152000 + (c_custkey * 86400 * 3) % 157680000) * 1000000) AS DATE)
      AS joined_date,
    CASE WHEN c_custkey % 50 = 3 THEN NULL
         ELSE make_timestamp((1600000000 + c_custkey * 61) * 1000000) END AS last_online_at,
    c_custkey % 4 = 2 AS is_streamer,
    'https://games.example.org/member/player' || c_custkey AS profile_url,
    make_timestamp((1700000000 + CASE WHEN c_custkey % 4 = 0 THEN 86400 ELSE 0 END)
                   * 1000000::BIGINT) AS _ingested_at
  FROM customer
),
stats AS (
  SELECT c, {_ratings("rating")}, {_ratings("best_rating")},
    {_career("win")} AS career_wins, {_career("loss")} AS career_losses,
    {_career("draw")} AS career_draws,
    CASE WHEN c % 3 = 0 THEN 1800 + c % 900 END AS fide_rating
  FROM (SELECT c_custkey AS c, CASE WHEN c_custkey % 4 = 2 THEN 1 ELSE 0 END AS copy
        FROM customer WHERE c_custkey % 7 <> 5)
),
players AS (
  SELECT p.username, player_id, display_name,
    coalesce(title, CASE WHEN p.c % 9 = 0 THEN 'GM' WHEN p.c % 10 = 0 THEN 'IM' END) AS title,
    p.c % 9 = 0 OR p.c % 10 = 0 AS is_titled, membership_status, country_code, followers,
    joined_date, year(joined_date) AS join_cohort_year, last_online_at, is_streamer, profile_url,
    rapid_rating, blitz_rating, bullet_rating, rapid_best_rating, blitz_best_rating,
    bullet_best_rating,
    greatest(coalesce(rapid_rating, 0), coalesce(blitz_rating, 0), coalesce(bullet_rating, 0))
      AS peak_current_rating,
    fide_rating, career_wins, career_losses, career_draws,
    career_wins / nullif(career_wins + career_losses + career_draws, 0)::DOUBLE AS career_win_rate,
    _ingested_at
  FROM profiles p LEFT JOIN stats USING (c)
)"""


def _checks(source: str) -> str:
    draws = (
        "'draw_agreed', 'draw_repetition', 'draw_stalemate', 'draw_insufficient_material',"
        " 'draw_50_move', 'draw_timeout_vs_insufficient'"
    )
    checks = [
        ("game_id_not_null", "error", "game_id IS NULL", 0, "every game needs its natural key"),
        ("game_id_unique", "error", None, 0, "a game may appear once"),
        ("game_date_not_null", "error", "game_date IS NULL", 0, "the partition column must be set"),
        ("players_not_null", "error", "player_white IS NULL OR player_black IS NULL", 0,
         "both players must be known"),
        ("elo_in_range", "error",
         "white_elo < 100 OR white_elo > 3600 OR black_elo < 100 OR black_elo > 3600", 0.1,
         "ratings lie between 100 and 3600"),
        ("outcome_valid", "error", "outcome NOT IN ('1-0', '0-1', '1/2-1/2')", 0,
         "the outcome is one of three"),
        ("no_future_dates", "error", "game_date > DATE '1995-09-01'", 0,
         "a game cannot end after today"),
        ("total_moves_positive", "error", "total_moves IS NULL OR total_moves <= 0", 0.5,
         "a game without counted moves was not read properly"),
        ("winner_present_when_decisive", "error",
         "winner_color IS NULL AND outcome <> '1/2-1/2'", 0, "a decided game names its winner"),
        ("decisive_not_draw_terminated", "error", "NOT is_draw AND termination LIKE 'draw\\_%' ESCAPE '\\'",
         0, "a decided game cannot end by a draw reason"),
        ("no_self_play", "error", "player_white = player_black", 0, "the players differ"),
        ("rows_present", "error", None, 0, "the window holds games"),
        ("termination_mapped", "warn", "termination = 'unknown'", 1,
         "a result code is missing from the vocabulary"),
        ("draw_reason_mapped", "warn", f"is_draw AND termination NOT IN ({draws})", 1,
         "a draw reason is missing from the vocabulary"),
        ("time_class_known", "warn", "time_class = 'unknown'", 1,
         "a format is missing from the vocabulary"),
        ("total_moves_plausible", "warn", "total_moves > 500", 0.1,
         "no more than 500 moves are expected"),
        ("eco_code_present", "warn", "eco_code IS NULL", 5,
         "opening models leave games without a code out"),
    ]
    branches = []
    for name, severity, condition, threshold, detail in checks:
        failed = f"count(*) FILTER (WHERE {condition})" if condition else "0"
        if name == "game_id_unique":
            failed = "count(*) - count(DISTINCT game_id)"
        total = "count(*)"
        if name == "rows_present":
            failed, total = "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "greatest(count(*), 1)"
        branches.append(
            f"SELECT '{name}' AS check_name, '{severity}' AS severity,"
            f" ({failed})::BIGINT AS failed_rows, ({total})::BIGINT AS total_rows,"
            f" {threshold}::DOUBLE AS threshold_pct, '{detail}' AS detail FROM {source}"
        )
    return "\nUNION ALL\n".join(branches)


def _share(condition: str) -> str:
    return f"(count(*) FILTER (WHERE {condition})) / count(*)::DOUBLE"


_TREND = """
weekly AS (
  SELECT CAST(date_trunc('week', game_date) AS DATE) AS week_start_date, username, time_class,
    count(*) AS games_played, avg(score) AS score_rate, avg(elo::DOUBLE) AS avg_elo,
    min(elo) AS min_elo, max(elo) AS max_elo,
    first(elo ORDER BY ended_at, game_id, color) AS opening_elo,
    first(elo ORDER BY ended_at DESC, game_id DESC, color DESC) AS closing_elo
  FROM results WHERE elo IS NOT NULL AND rated GROUP BY ALL
)"""

_COHORTS = f"""
activity AS (
  SELECT username, time_class, count(*) AS games_played, avg(score) AS score_rate,
    avg(elo::DOUBLE) AS avg_elo, max(elo) AS peak_elo, min(game_date) AS first_day,
    max(game_date) AS last_day, avg(total_moves) AS avg_moves
  FROM results WHERE rated AND elo IS NOT NULL GROUP BY ALL
)
SELECT join_cohort_year, time_class, count(DISTINCT username) AS cohort_size,
  sum(games_played)::BIGINT AS total_games, avg(games_played) AS avg_games_per_player,
  quantile_disc(games_played, 0.5) AS median_games_per_player,
  round(avg(avg_elo), 6) AS avg_elo, avg(peak_elo) AS avg_peak_elo,
  quantile_disc(round(avg_elo)::BIGINT, 0.5) AS median_avg_elo,
  round(avg(score_rate), 6) AS avg_score_rate, round(avg(avg_moves), 6) AS avg_total_moves,
  1995 - join_cohort_year AS cohort_age_years,
  avg(last_day - first_day) AS avg_active_span_days,
  count(*) FILTER (WHERE last_day >= DATE '1995-08-02') AS players_active_last_30d,
  {_share("last_day >= DATE '1995-08-02'")} AS active_last_30d_rate,
  count(DISTINCT username) >= 10 AS is_significant_sample
FROM activity JOIN players USING (username)
GROUP BY join_cohort_year, time_class"""

_RUN = """
SELECT 'logged-run' AS run_id, task_id, layer, layer || '.' || task_id AS target_table,
  'success' AS status, DATE '1995-01-01' AS window_start, DATE '1995-12-31' AS window_end,
  rows_written
FROM (
  SELECT 'clean_games' AS task_id, 'silver' AS layer, (SELECT count(*) FROM games) AS rows_written
  UNION ALL SELECT 'player_game_results', 'silver', 0
  UNION ALL SELECT 'openings_dim', 'silver', (SELECT count(*) FROM openings)
  UNION ALL SELECT 'dim_players', 'silver', (SELECT count(*) FROM players)
  UNION ALL SELECT 'daily_player_kpis', 'gold',
    (SELECT count(*) FROM (SELECT DISTINCT game_date, username, time_class FROM results))
  UNION ALL SELECT 'opening_win_rates', 'gold',
    (SELECT count(*) FROM (SELECT DISTINCT eco_code, elo_bracket_white, time_class FROM games
      WHERE eco_code IS NOT NULL AND elo_bracket_white IS NOT NULL AND rated))
  UNION ALL SELECT 'elo_trend_weekly', 'gold', (SELECT count(*) FROM weekly)
  UNION ALL SELECT 'time_control_meta', 'gold',
    (SELECT count(*) FROM (SELECT DISTINCT elo_bracket_white, time_class FROM games
      WHERE elo_bracket_white IS NOT NULL AND rated))
  UNION ALL SELECT 'player_cohorts', 'gold',
    (SELECT count(*) FROM (SELECT DISTINCT join_cohort_year, time_class
      FROM results JOIN players USING (username) WHERE rated AND elo IS NOT NULL))
)"""

_TASKS = """(VALUES ('clean_games', 'silver', 1), ('player_game_results', 'silver', 1),
  ('openings_dim', 'silver', 1), ('dim_players', 'silver', 1), ('dq_results', 'dq', 1),
  ('dq_gate', 'dq', 2), ('daily_player_kpis', 'gold', 3), ('opening_win_rates', 'gold', 3),
  ('elo_trend_weekly', 'gold', 3), ('time_control_meta', 'gold', 3), ('player_cohorts', 'gold', 3))
  AS tasks (name, layer, stage)"""


def _gated(run_id: str) -> str:
    """Tasks of a run by what its checks found, and the checks that failed."""
    return f"""
SELECT '{run_id}' AS run_id, name, layer,
  CASE WHEN stage = 1 OR NOT EXISTS (SELECT 1 FROM blocking) THEN 'success'
       WHEN stage = 2 THEN 'failed' ELSE 'skipped' END AS status,
  NULL::INTEGER AS place, NULL::BIGINT AS failed_rows
FROM {_TASKS}
UNION ALL
SELECT '{run_id}', check_name, 'check', 'failed', place, failed_rows FROM blocking"""


def _blocking(source: str, as_of: str) -> str:
    return f"""blocking AS (
  SELECT check_name, failed_rows, row_number() OVER (
      ORDER BY round(failed_rows / total_rows::DOUBLE * 100, 4) DESC, check_name)::INTEGER AS place
  FROM ({_checks(source).replace("1995-09-01", as_of)})
  WHERE severity = 'error' AND failed_rows / nullif(total_rows, 0)::DOUBLE * 100 > threshold_pct
)"""


ARCHIVES = {
    "gated_runs": f"""WITH {GAMES},
sound AS (SELECT * FROM games WHERE player_white <> player_black AND total_moves > 0)
SELECT * FROM (WITH {_blocking("games", "1995-09-01")} {_gated("as-landed")})
UNION ALL
SELECT * FROM (WITH {_blocking("sound", "1995-12-31")} {_gated("sound-only")})""",
    "clean_games": f"WITH {GAMES} SELECT * FROM games",
    "landed_games_window": "WITH "
    + clean_ctes(
        "year * 100 + month BETWEEN 199502 AND 199505",
        "game_date BETWEEN DATE '1995-02-10' AND DATE '1995-05-20'",
    )
    + " SELECT * FROM games",
    "player_game_results": f"WITH {RESULTS} SELECT * FROM results",
    "openings_dim": f"WITH {GAMES}{OPENINGS} SELECT * FROM openings",
    "dim_players": f"WITH {PLAYERS} SELECT * FROM players",
    "daily_player_kpis": f"""WITH {RESULTS}
SELECT game_date, username, time_class, count(*) AS games_played,
  count(*) FILTER (WHERE result = 'win') AS wins,
  count(*) FILTER (WHERE result = 'loss') AS losses,
  count(*) FILTER (WHERE result = 'draw') AS draws,
  {_share("result = 'win'")} AS win_rate, avg(score) AS score_rate,
  count(*) FILTER (WHERE color = 'white') AS games_as_white,
  count(*) FILTER (WHERE color = 'black') AS games_as_black,
  avg(total_moves) AS avg_total_moves,
  max(CASE WHEN seq_asc = 1 THEN elo END) AS elo_first,
  max(CASE WHEN seq_desc = 1 THEN elo END) AS elo_last,
  max(CASE WHEN seq_desc = 1 THEN elo END) - max(CASE WHEN seq_asc = 1 THEN elo END) AS elo_delta,
  avg(opponent_elo) AS avg_opponent_elo, count(DISTINCT eco_code) AS distinct_openings
FROM (
  SELECT *,
    row_number() OVER (PARTITION BY username, game_date, time_class
                       ORDER BY ended_at, game_id, color) AS seq_asc,
    row_number() OVER (PARTITION BY username, game_date, time_class
                       ORDER BY ended_at DESC, game_id DESC, color DESC) AS seq_desc
  FROM results
)
GROUP BY game_date, username, time_class""",
    "elo_trend_weekly": f"""WITH {RESULTS},{_TREND}
SELECT week_start_date, username, time_class, games_played, score_rate, avg_elo, min_elo, max_elo,
  opening_elo, closing_elo, closing_elo - opening_elo AS elo_change_in_week,
  lag(closing_elo) OVER w AS prev_week_closing_elo,
  closing_elo - lag(closing_elo) OVER w AS elo_change_wow,
  ((week_start_date - lag(week_start_date) OVER w) // 7)::BIGINT AS weeks_since_prev_active
FROM weekly
WINDOW w AS (PARTITION BY username, time_class ORDER BY week_start_date)""",
    "opening_win_rates": f"""WITH {GAMES}{OPENINGS}
SELECT g.eco_code, coalesce(o.opening_name, 'Unknown') AS opening_name, o.eco_volume,
  elo_bracket, time_class, games, white_wins, black_wins, draws,
  white_wins / games::DOUBLE AS white_win_rate, black_wins / games::DOUBLE AS black_win_rate,
  draws / games::DOUBLE AS draw_rate,
  (white_wins + 0.5::DOUBLE * draws) / games AS white_score_rate,
  avg_total_moves, checkmate_rate, games >= 30 AS is_significant_sample
FROM (
  SELECT eco_code, elo_bracket_white AS elo_bracket, time_class, count(*) AS games,
    count(*) FILTER (WHERE outcome = '1-0') AS white_wins,
    count(*) FILTER (WHERE outcome = '0-1') AS black_wins,
    count(*) FILTER (WHERE is_draw) AS draws, avg(total_moves) AS avg_total_moves,
    {_share("termination = 'checkmate'")} AS checkmate_rate
  FROM games
  WHERE eco_code IS NOT NULL AND elo_bracket_white IS NOT NULL AND rated
  GROUP BY ALL
) g LEFT JOIN openings o USING (eco_code)""",
    "time_control_meta": f"""WITH {GAMES}
SELECT time_class, elo_bracket_white AS elo_bracket, count(*) AS games,
  avg(total_moves) AS avg_total_moves, quantile_disc(total_moves, 0.5) AS median_total_moves,
  quantile_disc(total_moves, 0.9) AS p90_total_moves,
  {_share("is_draw")} AS draw_rate, {_share("NOT is_draw")} AS decisive_rate,
  {_share("termination = 'checkmate'")} AS checkmate_rate,
  {_share("termination = 'resignation'")} AS resignation_rate,
  {_share("termination = 'timeout'")} AS timeout_rate,
  {_share("termination = 'abandonment'")} AS abandonment_rate,
  {_share("termination = 'unknown'")} AS unknown_termination_rate,
  avg(abs(white_elo - black_elo)) AS avg_elo_gap,
  avg(CASE WHEN NOT is_daily THEN base_time_sec END) AS avg_base_time_sec,
  avg(CASE WHEN NOT is_daily THEN increment_sec END) AS avg_increment_sec,
  count(*) FILTER (WHERE is_daily) AS daily_games
FROM games WHERE rated AND elo_bracket_white IS NOT NULL
GROUP BY time_class, elo_bracket_white""",
    "player_cohorts": f"WITH {RESULTS},{PLAYERS},{_COHORTS}",
    "dq_results": f"""WITH {GAMES}
SELECT 'check-run' AS run_id, check_name, 'silver.clean_games' AS target_table, severity,
  failed_rows, total_rows,
  round(coalesce(failed_rows / nullif(total_rows, 0)::DOUBLE * 100, 0), 4) AS failed_pct,
  threshold_pct,
  coalesce(failed_rows / nullif(total_rows, 0)::DOUBLE * 100, 0) <= threshold_pct AS passed,
  detail, DATE '1995-01-01' AS window_start, DATE '1995-12-31' AS window_end
FROM ({_checks("games")})""",
    "run_log": f"WITH {RESULTS}{OPENINGS},{PLAYERS},{_TREND}{_RUN}",
    "header_tags": f"""WITH {RAW_GAMES}
SELECT tag, value, count(*) AS games
FROM (
  SELECT regexp_extract(line, '^\\[(\\w+)', 1) AS tag,
         regexp_extract(line, '"(.*)"', 1) AS value
  FROM (SELECT unnest(string_split(split_part(pgn, E'\\n\\n', 1), E'\\n')) AS line FROM raw_games)
  WHERE line <> ''
)
GROUP BY tag, value""",
    "landed_units": f"""WITH {RAW_GAMES},
units AS (
  SELECT *, 'account' || (CAST(substr(white_name, 7) AS BIGINT) % 40) AS player FROM raw_games
),
landed AS (
  SELECT *, month = 3 AND bool_or(coalesce(rated, FALSE)) OVER (PARTITION BY player, year, month)
    AS is_replaced
  FROM units
)
SELECT player, year, month, count(*) AS games, count(*) FILTER (WHERE rated) AS rated_games,
  count(*) AS stamped, 1::BIGINT AS endpoints,
  'player/' || player || '/games/' || year || '/' || month AS endpoint,
  min(end_time) AS first_end, max(end_time) AS last_end
FROM landed WHERE NOT is_replaced OR rated GROUP BY player, year, month""",
    "landed_player_stats": """SELECT 'player' || c_custkey AS username,
  CASE WHEN c_custkey % 3 = 0 THEN 1800 + c_custkey % 900 END AS fide,
  'player/player' || c_custkey || '/stats' AS _source_endpoint, TRUE AS stamped
FROM customer, range(2) AS copies(copy)
WHERE c_custkey % 7 <> 5 AND (c_custkey % 9 = 0 OR c_custkey % 10 = 0)
  AND (copy = 0 OR c_custkey % 4 = 2)""",
    "landed_broken_lines": f"""WITH {RAW_GAMES},
lines AS (SELECT *, CAST(substr(uuid, 3) AS BIGINT) % 11 AS n FROM raw_games),
told AS (
  SELECT *, CASE n WHEN 0 THEN '{{"url":"https:/' WHEN 1 THEN 'no json ' || uuid END AS text,
    CASE WHEN n < 2 THEN 'unreadable' WHEN n = 2 THEN 'badly typed' ELSE 'sound' END AS state
  FROM lines
)
SELECT year, month, state, count(*) AS lines, count(*) FILTER (WHERE n >= 2) AS identified,
  count(end_time) FILTER (WHERE n > 2) AS timed, min(text) AS first_text, max(text) AS last_text
FROM told GROUP BY year, month, state""",
    "landing_summary": f"""WITH {RAW_GAMES}
SELECT count(DISTINCT lower(white_name)) AS players,
  count(DISTINCT (lower(white_name), year, month)) AS partitions, count(*) AS games
FROM raw_games""",
    "missing_players": """SELECT 'player' || c_custkey AS username FROM customer
WHERE (c_custkey % 9 = 0 OR c_custkey % 10 = 0) AND c_custkey % 7 = 5""",
    "seed_players": """SELECT 'PLAYER' || c_custkey AS username FROM customer
WHERE c_custkey % 9 = 0 ORDER BY 1 LIMIT 50""",
}
