"""Write semantics, landing and the layered run on real folders."""

import datetime as dt
import gzip
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from rookery import schemas
from rookery.operators import checks, tables
from rookery.plans import run, silver
from rookery.sources import bronze, feed, landing
from tests.conftest import SAMPLES, game, one, side

D = dt.date


def rows(spark, *items):
    return spark.createDataFrame(items, "k STRING, day DATE, v INT")


def content(spark, path):
    table = tables.read_table(spark, path, rows(spark, ("x", D(2026, 1, 1), 0)).schema)
    return sorted(tuple(r) for r in table.collect())


def test_upsert_matches_by_key_inside_the_window_only(spark, folder):
    path = f"{folder}/t"
    first = rows(spark, ("a", D(2026, 1, 1), 1), ("b", D(2026, 1, 2), 1), ("c", D(2026, 1, 3), 1))
    assert tables.upsert_window(first, path, "k", "day", D(2026, 1, 1), D(2026, 1, 3)) == 3
    # b moves to another day and empties its own; c lies outside the window.
    batch = rows(spark, ("b", D(2026, 1, 1), 2), ("d", D(2026, 1, 1), 2))
    for _ in range(2):  # a re-run changes nothing
        tables.upsert_window(batch, path, "k", "day", D(2026, 1, 1), D(2026, 1, 2))
        assert content(spark, path) == [
            ("a", D(2026, 1, 1), 1), ("b", D(2026, 1, 1), 2), ("c", D(2026, 1, 3), 1),
            ("d", D(2026, 1, 1), 2),
        ]
    assert tables.partition_dates(spark, path, "day") == [D(2026, 1, 1), D(2026, 1, 3)]


def test_replace_window_removes_days_without_rows(spark, folder):
    path = f"{folder}/t"
    tables.rebuild(rows(spark, *[(str(d), D(2026, 1, d), d) for d in range(1, 6)]), path, "day")
    fresh = rows(spark, ("new", D(2026, 1, 3), 0))
    assert tables.replace_window(fresh, path, "day", D(2026, 1, 2), D(2026, 1, 4)) == 1
    assert [k for k, _, _ in content(spark, path)] == ["1", "5", "new"]
    nothing = fresh.filter("false")
    assert tables.replace_window(nothing, path, "day", D(2026, 1, 1), D(2026, 1, 4)) == 0
    assert [k for k, _, _ in content(spark, path)] == ["5"]


def test_rows_outside_the_window_are_refused_and_leave_the_table_alone(spark, folder):
    path = f"{folder}/t"
    tables.rebuild(rows(spark, ("a", D(2026, 1, 1), 1)), path, "day")
    stray = rows(spark, ("b", D(2026, 2, 1), 1))
    with pytest.raises(Exception, match="outside the window"):
        tables.replace_window(stray, path, "day", D(2026, 1, 1), D(2026, 1, 31))
    assert content(spark, path) == [("a", D(2026, 1, 1), 1)]


def test_failed_rebuild_keeps_the_old_table(spark, folder):
    path = f"{folder}/t"
    tables.rebuild(rows(spark, ("a", D(2026, 1, 1), 1)), path)
    broken = rows(spark, ("b", D(2026, 1, 1), 1)).withColumn(
        "v", F.raise_error(F.lit("boom")).cast("int")
    )
    with pytest.raises(Exception, match="boom"):
        tables.rebuild(broken, path)
    assert content(spark, path) == [("a", D(2026, 1, 1), 1)]
    assert tables.rebuild(rows(spark, ("c", D(2026, 1, 1), 1)), path) == 1
    assert [k for k, _, _ in content(spark, path)] == ["c"]


def test_append_create_and_expire(spark, folder):
    path = f"{folder}/t"
    schema = rows(spark, ("a", D(2026, 1, 1), 1)).schema
    tables.create_if_missing(spark, path, schema)
    tables.create_if_missing(spark, path, schema)
    assert content(spark, path) == []
    path = f"{folder}/dated"
    for day in (1, 20):
        assert tables.append(rows(spark, ("a", D(2026, 1, day), 1)), path, "day") == 1
    assert tables.expire(spark, path, "day", D(2026, 2, 15), keep_days=30) == [D(2026, 1, 1)]
    assert [d for _, d, _ in content(spark, path)] == [D(2026, 1, 20)]


def test_hot_date_is_split_over_files(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        hot = spark.range(60000).select(
            F.sha2(F.col("id").cast("string"), 256).alias("k"),
            F.when(F.col("id") % 3 == 0, F.lit(D(2026, 1, 1))).otherwise(
                F.date_add(F.lit(D(2026, 2, 1)), (F.col("id") % 20).cast("int"))
            ).alias("day"),
            F.lit(1).alias("v"),
        ).repartition(16)
        tables.rebuild(hot, f"{folder}/t", "day")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{folder}/t/day=2026-01-01") if f.endswith(".parquet")]
    assert len(files) > 3
    assert spark.read.parquet(f"{folder}/t").count() == 60000


# --- landing ------------------------------------------------------------------


def test_landing_overwrites_exactly_one_unit(spark, folder, raw):
    path = f"{folder}/games"
    base = raw().withColumn("player", F.lower("white.username"))
    assert landing.land_games(base, path) == 3
    one_unit = base.filter("player = 'bert'").withColumn("fen", F.lit("again"))
    assert landing.land_games(one_unit, path) == 1
    back = bronze.raw_games(spark, path)
    assert {(r.fen, r.year, r.month) for r in back.collect()} == {
        ("fen-98234571", 2026, 8), ("again", 2026, 8), ("fen-98235123", 2026, 8),
    }
    line = json.loads(
        next(
            open(os.path.join(root, name)).readline()
            for root, _, names in os.walk(path) for name in names if name.endswith(".json")
        )
    )
    assert "_ingested_at" in line and line["_ingested_at"] is None  # NULLs stay in the payload


def test_scans_prune_months(spark, folder, raw):
    path = f"{folder}/games"
    landing.land_units(raw([game(1), game(2, month=7), game(3, year=2025)]), path, ["year", "month"])
    days = D(2026, 8, 1), D(2026, 8, 31)
    window = silver.prune_months(bronze.raw_games(spark, path), *days, slack_months=0)
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert [r.fen for r in window.collect()] == ["fen-1"]
    wide = silver.prune_months(bronze.raw_games(spark, path), *days)
    assert {r.fen for r in wide.collect()} == {"fen-1", "fen-2"}


def test_reshaping_of_documents(spark):
    lists = spark.createDataFrame([("gm", ["Anna", "Bert"]), ("im", [])], "title STRING, players ARRAY<STRING>")
    players = landing.stamp_lineage(landing.flatten_titles(lists), F.concat(F.lit("titled/"), "title"))
    got = [(r.username, r.title, r._source_endpoint) for r in players.orderBy("username").collect()]
    assert got == [("Anna", "GM", "titled/GM"), ("Bert", "GM", "titled/GM")]
    assert [r.username for r in landing.seed_players(players, "gm", 1).collect()] == ["Anna"]

    months = spark.createDataFrame(
        [("anna", 2026, 8, [(1, "x"), (2, "y")]), ("anna", 2026, 7, []), ("bert", 2026, 8, None)],
        "player STRING, year INT, month INT, games ARRAY<STRUCT<id: INT, v: STRING>>",
    )
    flat = landing.flatten_months(months)
    assert flat.count() == 2 and flat.columns == ["player", "year", "month", "id", "v"]
    summary = one(landing.landing_summary(flat))
    assert tuple(summary) == (1, 1, 2)

    urls = [f"https://x/player/anna/games/{y}/{m:02d}" for y, m in [(2025, 12), (2026, 1), (2026, 8)]]
    index = spark.createDataFrame([("Anna", u) for u in urls], "player STRING, url STRING")
    newest = landing.recent_months(index, 2).orderBy("month").collect()
    assert [(r.player, r.year, r.month) for r in newest] == [("anna", 2026, 1), ("anna", 2026, 8)]

    stats = landing.stamp_username(spark.range(1), F.lit("ANNA"))
    assert one(stats).username == "anna"
    wanted = spark.createDataFrame([("Anna",), ("Carl",)], "username STRING")
    assert [r.username for r in landing.missing_players(wanted, stats).collect()] == ["carl"]


def test_event_feed_files(spark, folder):
    frame = spark.createDataFrame([("e1", "g1", "move", None)], "event_id STRING, game_id STRING, event_type STRING, ply INT")
    feed.write_ndjson(frame, f"{folder}/feed")
    line = spark.read.text(f"{folder}/feed").first()[0]
    assert line == '{"event_id":"e1","game_id":"g1","event_type":"move","ply":null}'


# --- the layered run ----------------------------------------------------------


@pytest.fixture
def lake(spark, folder, raw):
    lake = run.Lake(landing=f"{folder}/raw", tables=f"{folder}/tables")
    landing.land_games(
        raw().withColumn("player", F.lower("white.username")), f"{lake.landing}/games"
    )
    at = dt.datetime(2026, 9, 1)
    profile = ("Anna", 1, "Anna A", None, "basic", "https://x/country/DE", 3, 1_400_000_000, None, None, "u", at, "p")
    profiles = spark.createDataFrame([profile], schemas.RAW_PROFILES)
    landing.land_players(profiles, f"{lake.landing}/players/profiles")
    stats = spark.createDataFrame([], schemas.RAW_STATS)
    stats.write.json(f"{lake.landing}/players/stats")
    titled = spark.createDataFrame([("ANNA", "WGM", at, "t")], schemas.RAW_TITLED)
    landing.land_titles(titled, f"{lake.landing}/titled")
    return lake


def test_run_twice_gives_the_same_tables(spark, lake):
    window = (D(2026, 8, 1), D(2026, 8, 31))
    for run_id in ("r1", "r2"):
        run.run_window(spark, lake, *window, as_of=D(2026, 9, 1), run_id=run_id)
    read = lambda name: spark.read.parquet(lake.table(name))
    assert read("silver/clean_games").count() == len(SAMPLES)
    assert read("gold/daily_player_kpis").count() == 6
    player = one(read("silver/dim_players"))
    assert (player.title, player.is_titled, player.country_code) == ("WGM", True, "DE")
    assert (player.career_wins, player.peak_current_rating, player.is_streamer) == (None, 0, False)
    assert read("gold/player_cohorts").count() == 2
    assert read("ops/dq_results").groupBy("run_id").count().count() == 2
    log = tables.read_table(spark, lake.table("ops/pipeline_runs"), schemas.RUN_LOG)
    assert log.count() == 22 and log.filter("status = 'success'").count() == 22
    assert one(log.filter("run_id = 'r2' AND task_id = 'clean_games'")).rows_written == 3
    assert spark.table("player_game_results").count() == 6


def test_run_stops_at_the_gate_and_at_failures(spark, lake, raw):
    bad = raw([game(5, black=side("Anna", 2000, "resigned"))]).withColumn("player", F.lit("bad"))
    landing.land_games(bad, f"{lake.landing}/games")
    window = (D(2026, 8, 1), D(2026, 8, 31))
    with pytest.raises(checks.ChecksFailed, match="no_self_play"):
        run.run_window(spark, lake, *window, as_of=D(2026, 9, 1), run_id="gated")
    assert spark.read.parquet(lake.table("ops/dq_results")).count() == 17

    missing = run.Lake(landing=f"{lake.landing}/nowhere", tables=lake.tables)
    with pytest.raises(Exception):
        run.run_window(spark, missing, *window, layers=["silver"], run_id="broken")
    log = tables.read_table(spark, lake.table("ops/pipeline_runs"), schemas.RUN_LOG)
    stopped = log.filter("run_id = 'broken'")
    assert stopped.filter("status = 'skipped'").count() == 3
    row = one(stopped.filter("status <> 'skipped'"))
    assert (row.task_id, row.status) == ("clean_games", "failed") and row.error_message


def test_a_gate_before_the_marts_keeps_them_as_they_were(spark, lake, raw):
    window = (D(2026, 8, 1), D(2026, 8, 31))
    options = {"as_of": D(2026, 9, 1), "layers": ["gold", "silver", "dq"], "gate_first": True}
    landing.land_games(raw().withColumn("player", F.lit("p")), f"{lake.landing}/games")
    run.run_window(spark, lake, *window, run_id="good", **options)
    kpis = lake.table("gold/daily_player_kpis")
    before = spark.read.parquet(kpis).count()
    bad = raw([game(5, black=side("Anna", 2000, "resigned"))]).withColumn("player", F.lit("bad"))
    landing.land_games(bad, f"{lake.landing}/games")
    with pytest.raises(checks.ChecksFailed, match="no_self_play"):
        run.run_window(spark, lake, *window, run_id="bad", **options)
    assert spark.read.parquet(kpis).count() == before > 0
    log = tables.read_table(spark, lake.table("ops/pipeline_runs"), schemas.RUN_LOG)
    found = {
        r.run_id: r.by_status
        for r in log.groupBy("run_id", "status").count().groupBy("run_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("status", "count"))).alias("by_status"))
        .collect()
    }
    assert found == {"good": {"success": 11}, "bad": {"success": 5, "failed": 1, "skipped": 5}}


def test_run_arguments(spark, lake):
    with pytest.raises(ValueError):
        run.run_window(spark, lake, D(2026, 8, 2), D(2026, 8, 1))
    with pytest.raises(ValueError):
        run.run_window(spark, lake, D(2026, 8, 1), D(2026, 8, 2), layers=["bogus"])
    run.run_window(spark, lake, D(2026, 8, 1), D(2026, 8, 2), dry_run=True)
    assert not tables.exists(spark, lake.table("silver/clean_games"))


def test_a_failed_swap_puts_the_old_table_back(spark, folder, monkeypatch):
    path = f"{folder}/swapped"
    tables.rebuild(spark.range(3), path)
    real = tables._rename

    def failing(session, source, target):
        if ".new-" in source:
            raise OSError("no")
        real(session, source, target)

    monkeypatch.setattr(tables, "_rename", failing)
    with pytest.raises(OSError):
        tables.rebuild(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3


def test_refresh_shows_files_written_by_another_job(spark, folder):
    path = f"{folder}/grown"
    spark.range(3).write.parquet(path)
    seen = spark.read.parquet(path).cache()
    assert seen.count() == 3
    os.makedirs(f"{folder}/other")
    spark.range(4).write.parquet(f"{folder}/other/part")
    for name in os.listdir(f"{folder}/other/part"):
        if name.startswith("part-"):  # behind the session's back
            shutil.copy(f"{folder}/other/part/{name}", f"{path}/{name}")
    bronze.refresh(spark, path)
    assert seen.count() == spark.read.parquet(path).count() == 7
    seen.unpersist()


def test_compressed_units_hold_the_same_rows(spark, folder, raw):
    base = raw().withColumn("player", F.lower("white.username"))
    landing.land_games(base, f"{folder}/plain")
    assert landing.land_games(base, f"{folder}/small", "gzip") == 3
    names = [n for _, _, found in os.walk(f"{folder}/small") for n in found if n.startswith("part")]
    assert names and all(n.endswith(".json.gz") for n in names)
    plain, small = (bronze.raw_games(spark, f"{folder}/{n}") for n in ("plain", "small"))
    assert small.exceptAll(plain).isEmpty() and small.count() == 3


def test_json_lines_are_compressed_in_files_of_bounded_length(spark, folder, monkeypatch):
    monkeypatch.setattr(feed, "_LINES_A_FILE", 10)
    feed.write_ndjson(spark.range(35).coalesce(1), f"{folder}/lines", "gzip")
    names = [n for n in os.listdir(f"{folder}/lines") if n.startswith("part")]
    assert len(names) == 4 and all(n.endswith(".txt.gz") for n in names)
    assert spark.read.json(f"{folder}/lines").count() == 35


def test_compressed_json_lines_are_written_at_speed(spark, folder):
    rows = spark.range(20_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
        F.concat(F.lit("player"), F.col("id") % 500).alias("player"),
        (F.col("id") * 7919 % 1009).alias("elo"),
    )
    feed.write_ndjson(rows.coalesce(1), f"{folder}/lines", "gzip")
    (name,) = [n for n in os.listdir(f"{folder}/lines") if n.startswith("part")]
    with open(f"{folder}/lines/{name}", "rb") as file:
        written = file.read()
    lines = gzip.decompress(written)
    assert lines.count(b"\n") == 20_000
    fast, usual = (len(gzip.compress(lines, level)) for level in (1, 6))
    assert abs(len(written) - fast) < abs(len(written) - usual)


def test_replay_keeps_ids_of_any_form(spark, folder):
    """Ids that are digests are sorted as bytes, others as text; all come out as they were."""
    ids = ["ab" * 32, "AB" * 32, "abc", "", "g" * 64, None, "00", "été", "0" * 63]
    made = spark.createDataFrame(
        [(i, n, str(n % 3), n) for n, i in enumerate(ids)],
        "event_id string, us long, game_id string, ply long",
    ).withColumn("event_ts", F.timestamp_micros("us")).drop("us")
    events = spark.createDataFrame([], schemas.EVENT).unionByName(made, allowMissingColumns=True)
    plan = feed.sorted_for_replay(events)._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in plan.split("Sort [")[1]  # before the rows are moved
    feed.write_replay(events, f"{folder}/replay")
    found = spark.read.parquet(f"{folder}/replay").select(
        F.get_json_object(F.col("data").cast("string"), "$.event_id").alias("id"),
        F.get_json_object(F.col("data").cast("string"), "$.ply").cast("int").alias("n"),
    )
    assert [r.id for r in found.orderBy("n").collect()] == ids
    assert feed.sorted_for_replay(events).columns == events.columns


def test_many_units_are_landed_and_read_a_part_at_a_time(spark, folder, monkeypatch):
    monkeypatch.setattr(landing, "_UNITS_A_WRITE", 7)
    monkeypatch.setattr(bronze, "_UNITS_A_READ", 7)
    writes, reads, land, scan = [], [], landing.land_units, bronze._scan
    monkeypatch.setattr(
        landing, "land_units", lambda *a, **k: writes.append(land(*a, **k)) or writes[-1]
    )
    monkeypatch.setattr(bronze, "_scan", lambda s, p, *a: reads.append(len(p)) or scan(s, p, *a))
    path = f"{folder}/stats"
    name = F.when(F.col("id") > 0, F.concat(F.lit("Pläyer*{,}\n="), F.col("id") % 29))
    stats = spark.range(30).select(name.alias("username"), F.col("id").alias("fide"))
    assert landing.land_players(stats, path) == 30 and len(writes) == 5 and max(writes) < 30
    got = bronze.gathered(spark, path, schemas.RAW_STATS).select("username", "fide")
    assert sum(reads) == 30 and max(reads) == 7
    assert sorted(map(str, got.collect())) == sorted(map(str, stats.collect()))
    again = stats.filter("id % 2 = 1").withColumn("fide", F.col("fide") + 100)
    landing.land_players(again, path)
    got = bronze.gathered(spark, path, schemas.RAW_STATS).select("username", "fide")
    assert {r.username for r in got.collect()} == {r.username for r in stats.collect()}
    assert got.filter("fide > 50").count() == 15
    assert bronze.gathered(spark, f"{folder}/none", schemas.RAW_STATS).count() == 0


def test_small_units_are_written_by_several_tasks(spark, tmp_path):
    path = f"{tmp_path}/players"
    players = spark.range(60).select(F.concat(F.lit("Player"), "id").alias("username"))
    assert landing.land_players(players.coalesce(1), path) == 60
    files = spark.read.json(path).select("_metadata.file_name").distinct().collect()
    assert len({name.split("-")[1] for (name,) in files}) > 1  # numbers of the tasks
    assert landing.land_players(players.limit(1), path) == 1
    assert spark.read.json(path).count() == 60
