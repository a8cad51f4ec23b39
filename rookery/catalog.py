"""Every query by name, over the tables of a scale-factor folder."""

from __future__ import annotations

import datetime as dt
import functools
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import TimestampType

from rookery import schemas
from rookery.functions import derive
from rookery.operators import checks, tables
from rookery.operators.latest import latest_per_key
from rookery.plans import events as plays, gold, quality, reports, run, silver
from rookery.session import scratch_path, tune
from rookery.sources import bronze, feed, landing, tables_as_archives as archives
from rookery.streaming import contract, jobs, published, windows

Query = Callable[[SparkSession, str], DataFrame]

FIRST_DAY, LAST_DAY = dt.date(1995, 1, 1), dt.date(1995, 12, 31)
AS_OF = dt.date(1995, 9, 1)
REPLAY_START = 1_788_091_200  # 2026-08-30 12:00 UTC
AUDIT = ("_transformed_at", "checked_at", "emitted_at")


def _plain(df: DataFrame, *rounded: str) -> DataFrame:
    """Result form: no audit times, wall-clock timestamps, named doubles rounded.

    Means of non-integers depend on the order of summing in their last digits.
    """
    columns = []
    for field in df.schema.fields:
        if field.name in AUDIT:
            continue
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        if field.name in rounded:
            column = F.round(column, 6)
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- conformed tables and marts over derived archives -------------------------


def _games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_games(archives.raw_games(spark, sf_dir))


def _players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_players(
        archives.raw_profiles(spark, sf_dir),
        archives.raw_stats(spark, sf_dir),
        archives.raw_titled(spark, sf_dir),
    )


def clean_games(spark, sf_dir):
    return _games(spark, sf_dir)


def player_game_results(spark, sf_dir):
    return silver.player_game_results(_games(spark, sf_dir))


def openings_dim(spark, sf_dir):
    return silver.openings_dim(_games(spark, sf_dir))


def dim_players(spark, sf_dir):
    return _players(spark, sf_dir)


def daily_player_kpis(spark, sf_dir):
    return gold.daily_player_kpis(_games(spark, sf_dir))


def elo_trend_weekly(spark, sf_dir):
    return gold.elo_trend_weekly(_games(spark, sf_dir))


def opening_win_rates(spark, sf_dir):
    games = tables.stage(_games(spark, sf_dir), "games")
    return gold.opening_win_rates(games, silver.openings_dim(games))


def time_control_meta(spark, sf_dir):
    return gold.time_control_meta(_games(spark, sf_dir))


def player_cohorts(spark, sf_dir):
    cohorts = gold.player_cohorts(_games(spark, sf_dir), _players(spark, sf_dir), AS_OF)
    return _plain(cohorts, "avg_elo", "avg_score_rate", "avg_total_moves")


def dq_results(spark, sf_dir):
    games = tables.stage(_games(spark, sf_dir), "games")
    return quality.dq_results(games, "check-run", FIRST_DAY, LAST_DAY, AS_OF)


def landed_games_window(spark, sf_dir):
    """Land the archives as JSON by month, scan a window of it, conform it."""
    path = scratch_path(spark, "landing")
    landing.land_units(archives.raw_games(spark, sf_dir), path, ["year", "month"], "gzip")
    window = dt.date(1995, 2, 10), dt.date(1995, 5, 20)
    return silver.clean_games(bronze.raw_games(spark, path), *window)


def _landed_lake(spark, sf_dir, games):
    root = scratch_path(spark, "lake")
    lake = run.Lake(landing=f"{root}/raw", tables=f"{root}/tables")
    landing.land_units(games, f"{lake.landing}/games", ["year", "month"], "gzip")
    documents = {
        "players/profiles": archives.raw_profiles(spark, sf_dir),
        "players/stats": archives.raw_stats(spark, sf_dir),
        "titled": archives.raw_titled(spark, sf_dir),
    }
    for name, df in documents.items():
        landing.land_units(df, f"{lake.landing}/{name}", [], "gzip")
    return lake


def run_log(spark, sf_dir):
    """A whole layered run over landed data; its log."""
    lake = _landed_lake(spark, sf_dir, archives.raw_games(spark, sf_dir))
    run_id = run.run_window(
        spark, lake, FIRST_DAY, LAST_DAY, ["silver", "gold"], as_of=AS_OF, run_id="logged-run"
    )
    log = tables.read_table(spark, lake.table("ops/pipeline_runs"), schemas.RUN_LOG)
    return log.filter(F.col("run_id") == run_id).select(
        "run_id", "task_id", "layer", "target_table", "status", "window_start", "window_end",
        "rows_written",
    )


def gated_runs(spark, sf_dir):
    """Runs with the gate before the marts: all games as they are, and only sound ones.

    Every task with its status, and the blocking checks that failed, worst first.
    """
    raw = archives.raw_games(spark, sf_dir)
    white, black = F.lower("white.username"), F.lower("black.username")
    moves = derive.full_moves(derive.movetext(F.col("pgn")))
    inputs = {
        "as-landed": (raw, AS_OF),
        "sound-only": (raw.filter((white != black) & (moves > 0)), LAST_DAY),
    }
    parts = []
    for run_id, (games, as_of) in inputs.items():
        lake = _landed_lake(spark, sf_dir, games)
        try:
            run.run_window(
                spark, lake, FIRST_DAY, LAST_DAY, as_of=as_of, run_id=run_id, gate_first=True
            )
        except checks.ChecksFailed:
            pass  # what the log and the results tell is the result here
        log = tables.read_table(spark, lake.table("ops/pipeline_runs"), schemas.RUN_LOG)
        results = tables.read_table(spark, lake.table("ops/dq_results"), schemas.DQ_RESULTS)
        none = F.lit(None)
        parts += [
            log.select(
                "run_id", F.col("task_id").alias("name"), "layer", "status",
                none.cast("int").alias("place"), none.cast("bigint").alias("failed_rows"),
            ),
            # One row per declared check.
            checks.failing(results).select(
                F.lit(run_id).alias("run_id"), F.col("check_name").alias("name"),
                F.lit("check").alias("layer"), F.lit("failed").alias("status"),
                F.row_number().over(
                    Window.orderBy(F.desc("failed_pct"), "check_name")
                ).alias("place"),
                "failed_rows",
            ),
        ]
    return functools.reduce(DataFrame.unionByName, parts)


# --- moves, event log, messages -----------------------------------------------


def header_tags(spark, sf_dir):
    """Header tags of all game texts, counted per tag and value."""
    raw = archives.raw_games(spark, sf_dir)
    tags = raw.select(F.explode(derive.header_tags(F.col("pgn"))).alias("tag", "value"))
    return tags.groupBy("tag", "value").agg(F.count(F.lit(1)).alias("games"))


def game_moves(spark, sf_dir):
    """Half-moves of the newest copy of every game."""
    raw = archives.raw_games(spark, sf_dir).withColumn("game_id", derive.game_id(F.col("url")))
    newest = latest_per_key(
        raw.filter(F.col("game_id").isNotNull()).select(
            "game_id", "pgn", "_ingested_at", "_source_endpoint"
        ),
        ["game_id"],
        [F.desc("_ingested_at"), F.asc("_source_endpoint")],
    )
    return plays.explode_moves(newest, ["game_id"], derive.movetext(F.col("pgn")))


def _event_log(spark, sf_dir):
    """Replay of all games, half an hour of staggered starts, both copies."""
    return _replayed(plays.game_context(archives.raw_games(spark, sf_dir)))


def _replayed(contexts):
    offset = F.col("game_id").cast("bigint") % 1800
    return plays.game_event_log(contexts, F.timestamp_seconds(F.lit(REPLAY_START) + offset), 7.5)


_GAMES_A_TASK = 8192


def _unique_event_log(spark, sf_dir):
    """Replay of each game once: copies share id and start, so they are dropped as games.

    Games are dealt out by their number. Partitions sized by their bytes would hold so many
    games that a task could not sort their events, tens to a game, in memory.
    """
    contexts = plays.game_context(archives.raw_games(spark, sf_dir))
    tasks = math.ceil(archives.games(spark, sf_dir) / _GAMES_A_TASK)
    dealt = contexts.repartition(max(1, tasks), "game_id")
    return _replayed(latest_per_key(dealt, ["game_id"], [F.desc("white_elo")]))


def _distinct_events(events):
    """Each event id once: the batch form of the stream's deduplication."""
    return latest_per_key(events, ["event_id"], [F.asc("event_ts"), F.desc("white_elo")])


def game_event_log(spark, sf_dir):
    return _event_log(spark, sf_dir)


def feed_roundtrip(spark, sf_dir):
    """The event log as messages, read back through the contract, deduplicated, summed."""
    messages = feed.to_messages(_event_log(spark, sf_dir))
    events = _distinct_events(contract.accepted(contract.read_messages(messages)))
    return events.groupBy("event_type", "time_class", "color").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.sum("ply").alias("plies"),
        F.sum("total_moves").alias("total_moves"),
        F.round(F.sum("mover_clock_sec"), 2).alias("clock_seconds"),
        F.max("source_game_date").alias("last_game_date"),
        F.count("outcome").alias("outcomes"),
        F.min("opening_name").alias("first_opening"),
        F.max("move_san").alias("last_san"),
        F.sum("white_elo").alias("white_elo"),
        F.count_distinct("game_id").alias("games"),
    )


def ndjson_feed(spark, sf_dir):
    """The event log as JSON lines, read back."""
    path = scratch_path(spark, "ndjson")
    feed.write_ndjson(_unique_event_log(spark, sf_dir), path, "gzip")
    return spark.read.schema(schemas.EVENT).json(path)


def ordered_replay(spark, sf_dir):
    """Replay files, read back with each message's place, and what is out of order there.

    One row per game, whose messages have to come in the order of their times, and one for the
    whole feed, where no file may begin before the one before it has ended.
    """
    path = scratch_path(spark, "replay")
    feed.write_replay(_unique_event_log(spark, sf_dir), path)
    time = F.get_json_object(F.col("data").cast("string"), "$.event_ts").cast("timestamp")
    messages = spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        "key",
        time.alias("event_ts"),
    )
    return feed.order_by_game(messages).unionByName(feed.order_of_files(messages))


def game_sessions(spark, sf_dir):
    return windows.session_stats(_unique_event_log(spark, sf_dir))


def feed_throughput(spark, sf_dir):
    return windows.platform_stats(_unique_event_log(spark, sf_dir))


# One event in 26 of the table becomes each of these payloads.
_PAYLOADS = """CASE event_id % 26
    WHEN 0 THEN concat('not json ', event_id)
    WHEN 1 THEN concat('[', event_id, ']')
    WHEN 2 THEN '{"event_type": "move"}'
    WHEN 3 THEN concat('{"event_id":"', event_id, '","event_type":"teleport","event_ts":"', ts,
                       '","game_id":"', user_id, '"}')
    WHEN 4 THEN concat('{"event_id":"', event_id, '","event_type":"game_start","event_ts":"', ts,
                       '","game_id":"', user_id, '","surprise":1,"extra":2}')
    WHEN 5 THEN concat(head, '"move","move_number":1,"color":"white","move_san":"e4"}')
    WHEN 6 THEN concat(head, '"move","ply":0,"move_number":1,"color":"white","move_san":"e4"}')
    WHEN 7 THEN concat(head, '"move","ply":"1","move_number":1,"color":"white","move_san":"e4"}')
    WHEN 8 THEN concat(head, '"move","ply":1,"move_number":1,"color":"green","move_san":"e4"}')
    WHEN 9 THEN concat(head, '"move","ply":1,"move_number":1,"color":"white","move_san":""}')
    WHEN 10 THEN concat(head, '"game_end","outcome":"win","termination":"timeout"}')
    WHEN 11 THEN concat(head, '"game_end","outcome":"1-0"}')
    WHEN 12 THEN concat('{"event_id":"', event_id, '","event_type":"game_start",',
                        '"event_ts":"yesterday","game_id":"', user_id, '"}')
    WHEN 13 THEN concat('{"event_id":"', event_id, '","event_type":"game_start",',
                        '"event_ts":12,"game_id":"', user_id, '"}')
    WHEN 14 THEN concat('"', event_id, '"')
    WHEN 15 THEN concat(head, '"game_end","outcome":"0-1","termination":"resignation"}')
    WHEN 16 THEN concat(head, '"game_start","white_elo":', user_id, '}')
    WHEN 20 THEN concat(head, '"game_start","white_elo":"abc","black_elo":1.5}')
    WHEN 21 THEN concat(head, '"game_start","source_game_date":"nope"}')
    WHEN 22 THEN concat(head, '"move","ply":0,"color":"green","is_simulated":"maybe","odd":[1]}')
    WHEN 23 THEN concat('{"event_id":"e', event_id, '","event_type":"game_start","event_ts":"', ts,
                        '+02:00","game_id":"', user_id, '"} {}')
    WHEN 24 THEN concat('{"event_id":"e', event_id, '","event_type":"game_start","event_ts":"',
                        replace(translate(ts, '-:', ''), '.', ','), '789+0200","game_id":"',
                        user_id, '"}')
    WHEN 25 THEN concat('{"event_id":"e', event_id, '","event_type":"game_start","event_ts":"',
                        left(ts, 13), '+02","game_id":"', user_id, '"}')
    ELSE concat(head, '"move","ply":', user_id + 1, ',"move_number":', user_id div 2 + 1,
                ',"color":"black","move_san":"e5","mover_clock_sec":', value, '}') END"""


_VALID = [15, 16, 17, 18, 19, 24, 25]


def _messages(spark, sf_dir):
    # The table may be one row group: it is dealt out before payloads are made and parsed.
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "value", "ts"
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = events.repartition(partitions, "event_id").withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    head = F.expr(
        """concat('{"event_id":"e', event_id, '","event_ts":"', ts, '+02:00","game_id":"',
                  user_id, '","event_type":')"""
    )
    return events.withColumn("head", head).select(
        F.expr(_PAYLOADS).cast("binary").alias("data"),
        F.create_map(
            F.lit("event_id"), F.concat(F.lit("m"), "event_id"), F.lit("game_id"),
            F.col("user_id").cast("string"),
        ).alias("attributes"),
    )


def rejected_messages(spark, sf_dir):
    rejected = contract.dead_letters(contract.read_messages(_messages(spark, sf_dir)))
    return rejected.drop("received_at", "pipeline_version")


def accepted_messages(spark, sf_dir):
    return contract.accepted(contract.read_messages(_messages(spark, sf_dir)))


# --- streams ------------------------------------------------------------------


def _accepted(events):
    return events.withColumns({"received_at": F.col("event_ts"), "is_late": F.lit(False)})


def _streamed(spark, sf_dir, start):
    """Publish the event log as one batch of the events table, run one window query to its end."""
    layout = jobs.Layout(scratch_path(spark, "stream"))
    accepted = _accepted(_unique_event_log(spark, sf_dir))
    published.publish(accepted, layout.table("live_game_events"), 0, "event_ts")
    start(spark, layout, availableNow=True).awaitTermination()
    jobs.close_windows(spark, layout)
    return layout


def streamed_game_sessions(spark, sf_dir):
    """Sessions of a bounded feed: those the watermark closed and the rest."""
    return jobs.session_stats(spark, _streamed(spark, sf_dir, jobs.start_session_stats))


def streamed_throughput(spark, sf_dir):
    """Fixed windows of a bounded feed: those the watermark closed and the rest."""
    return jobs.platform_stats(spark, _streamed(spark, sf_dir, jobs.start_platform_stats))


def rerun_throughput(spark, sf_dir):
    """Fixed windows over a feed whose batches run again after the windows have read them.

    The log comes as messages in two batches; small batches are settled before the feed ends.
    """
    layout = jobs.Layout(scratch_path(spark, "rerun"))
    log = tables.stage(_unique_event_log(spark, sf_dir), "log")
    half = F.timestamp_seconds(F.lit(REPLAY_START + 1000))
    entry = jobs.entry_batch(layout)
    for batch, part in enumerate([log.filter(F.col("event_ts") < half),
                                  log.filter(F.col("event_ts") >= half)]):
        read = contract.read_messages(feed.to_messages(part))
        for _ in range(2):
            entry(read.withColumn("received_at", F.current_timestamp()), batch)
            jobs.start_platform_stats(spark, layout, availableNow=True).awaitTermination()
    jobs.settle(spark, layout, 0)
    jobs.close_windows(spark, layout)
    return jobs.platform_stats(spark, layout)


_EXPIRY_DAY = dt.date(2026, 11, 1)


def kept_event_days(spark, sf_dir):
    """Days of an events table, spread over two months, after old ones have expired."""
    layout = jobs.Layout(scratch_path(spark, "expiry"))
    path = layout.table("live_game_events")
    later = F.make_dt_interval(days=(F.col("game_id").cast("bigint") % 60).cast("int"))
    # A half is chosen among the games, before their events are made: nothing is staged.
    log = _unique_event_log(spark, sf_dir)
    log = _accepted(log.withColumn("event_ts", F.col("event_ts") + later))
    odd = F.col("game_id").cast("bigint") % 2 == 1
    for batch, part in enumerate([log.filter(odd), log.filter(~odd)]):
        published.publish(part, path, batch, "event_ts")
    published.settle(spark, path, schemas.ACCEPTED, 0)
    jobs.expire(spark, layout, _EXPIRY_DAY, keep_days=30)
    return jobs.marked_events(spark, layout).groupBy(F.to_date("event_ts").alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("game_id").alias("games")
    )


_BATCHES = 4


def _entered(spark, sf_dir):
    """The table's messages through the stream entry, in four batches with redeliveries.

    A batch brings a quarter of the messages, and once more the valid ones of
    the quarter before it.
    """
    root = scratch_path(spark, "entry")
    layout = jobs.Layout(f"{root}/tables")
    messages = _messages(spark, sf_dir).withColumn(
        "n", F.substr(F.col("attributes")["event_id"], F.lit(2)).cast("bigint")
    )
    for batch in range(_BATCHES):
        part = messages.filter(F.col("n") % _BATCHES == batch)
        again = messages.filter(
            (F.col("n") % _BATCHES == batch - 1) & (F.col("n") % 26).isin(_VALID)
        )
        arriving = part.unionByName(again).select("data", "attributes")
        arriving.write.mode("append").parquet(f"{root}/incoming")
        source = jobs.message_files(spark, f"{root}/incoming")
        jobs.start_entry(source, layout, availableNow=True).awaitTermination()
    return layout


def entered_events(spark, sf_dir):
    """Events of a feed with redeliveries, each once, and whether they came late."""
    layout = _entered(spark, sf_dir)
    return jobs.marked_events(spark, layout).select(*schemas.EVENT.fieldNames(), "is_late")


def entered_late_events(spark, sf_dir):
    late = jobs.late_events(spark, _entered(spark, sf_dir))
    return late.select("event_id", "game_id", "event_type", "event_ts", "window_start", "pane_info")


def entered_dead_letters(spark, sf_dir):
    letters = jobs.dlq_events(spark, _entered(spark, sf_dir))
    return letters.drop("received_at", "pipeline_version")


# --- landing ------------------------------------------------------------------


def _landed(spark, sf_dir):
    return archives.raw_games(spark, sf_dir).withColumn("player", F.lower("white.username"))


_ACCOUNTS = 40


def landed_units(spark, sf_dir):
    """Archives of forty accounts, landed one folder per year, month and account.

    The March units come a second time, with rated games only, and replace themselves alone.
    """
    path = scratch_path(spark, "units")
    account = F.regexp_extract(F.lower("white.username"), r"(\d+)\z", 1).cast("bigint") % _ACCOUNTS
    player = F.concat(F.lit("account"), account.cast("string"))
    endpoint = F.concat_ws("/", F.lit("player"), "player", F.lit("games"), "year", "month")
    fetched = archives.raw_games(spark, sf_dir).drop("_ingested_at", "_source_endpoint")
    stamped = landing.stamp_lineage(fetched.withColumn("player", player), endpoint)
    landing.land_games(stamped, path, "gzip")
    landing.land_games(stamped.filter("month = 3 AND rated"), path, "gzip")
    bronze.refresh(spark, path)
    return bronze.raw_games(spark, path).groupBy("player", "year", "month").agg(
        F.count(F.lit(1)).alias("games"),
        F.count_if("rated").alias("rated_games"),
        F.count("_ingested_at").alias("stamped"),
        F.count_distinct("_source_endpoint").alias("endpoints"),
        F.max("_source_endpoint").alias("endpoint"),
        F.min("end_time").alias("first_end"),
        F.max("end_time").alias("last_end"),
    )


def landed_player_stats(spark, sf_dir):
    """Statistics of the titled players, stamped with their name and landed one unit each."""
    path = scratch_path(spark, "stats")
    titled = archives.raw_titled(spark, sf_dir).select(F.lower("username").alias("username"))
    documents = archives.raw_stats(spark, sf_dir).join(titled, "username", "left_semi")
    fetched = documents.withColumnRenamed("username", "requested")
    named = landing.stamp_username(fetched, F.upper("requested"))
    endpoint = F.concat_ws("/", F.lit("player"), "username", F.lit("stats"))
    landing.land_players(landing.stamp_lineage(named, endpoint).drop("requested"), path)
    return bronze.gathered(spark, path, schemas.RAW_STATS).select(
        "username", "fide", "_source_endpoint", F.col("_ingested_at").isNotNull().alias("stamped")
    )


def landed_broken_lines(spark, sf_dir):
    """Lines of a landing by month and state, where some are cut off, no JSON or badly typed."""
    path = scratch_path(spark, "broken")
    games = archives.raw_games(spark, sf_dir).select("url", "uuid", "end_time", "year", "month")
    number = F.substr("uuid", F.lit(3)).cast("bigint") % 11
    line = F.to_json(F.struct("url", "uuid", "end_time"), {"ignoreNullFields": "false"})
    typed = F.regexp_replace(line, r'"end_time":[^}]*', '"end_time":"soon"')
    lines = games.select(
        F.when(number == 0, F.left(line, F.lit(15)))
        .when(number == 1, F.concat(F.lit("no json "), "uuid"))
        .when(number == 2, typed)
        .otherwise(line)
        .alias("value"),
        "year",
        "month",
    )
    lines.write.partitionBy("year", "month").text(path)
    read = bronze.with_broken(spark, path, schemas.RAW_GAMES)
    state = bronze.line_state("uuid")
    return read.groupBy("year", "month", state.alias("state")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("uuid").alias("identified"),
        F.count("end_time").alias("timed"),
        F.min(F.when(F.col("uuid").isNull(), F.col(bronze.BROKEN))).alias("first_text"),
        F.max(F.when(F.col("uuid").isNull(), F.col(bronze.BROKEN))).alias("last_text"),
    )


def landing_summary(spark, sf_dir):
    return landing.landing_summary(_landed(spark, sf_dir))


def missing_players(spark, sf_dir):
    return landing.missing_players(
        archives.raw_titled(spark, sf_dir), archives.raw_stats(spark, sf_dir)
    )


def seed_players(spark, sf_dir):
    return landing.seed_players(archives.raw_titled(spark, sf_dir), "gm", 50)


def _query(build: Query) -> Query:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(tune(spark), sf_dir))

    call.__name__, call.__doc__ = build.__name__, build.__doc__
    return call


_BUILDERS: list[Query] = [
    clean_games,
    player_game_results,
    openings_dim,
    dim_players,
    daily_player_kpis,
    elo_trend_weekly,
    opening_win_rates,
    time_control_meta,
    player_cohorts,
    dq_results,
    landed_games_window,
    run_log,
    gated_runs,
    header_tags,
    game_moves,
    game_event_log,
    feed_roundtrip,
    game_sessions,
    feed_throughput,
    rejected_messages,
    accepted_messages,
    entered_events,
    entered_late_events,
    entered_dead_letters,
    streamed_game_sessions,
    streamed_throughput,
    rerun_throughput,
    kept_event_days,
    ndjson_feed,
    ordered_replay,
    landed_units,
    landed_player_stats,
    landed_broken_lines,
    landing_summary,
    missing_players,
    seed_players,
    reports.latest_line_per_key,
    reports.daily_user_kpis,
    reports.weekly_user_trend,
    reports.return_rates,
    reports.value_quantiles,
    reports.nation_cohorts,
    reports.line_parties,
    reports.brand_types,
    reports.line_checks,
    reports.page_urls,
    reports.text_numbers,
    reports.event_props,
    reports.user_sessions,
    reports.hourly_throughput,
    reports.last_known_values,
    reports.document_moves,
    reports.role_words,
    reports.monthly_archives,
    reports.recent_order_months,
    reports.upserted_orders,
    reports.replaced_months,
]

QUERIES: dict[str, Query] = {build.__name__: _query(build) for build in _BUILDERS}
