"""One run of the layered models over a date window.

Each model is written, logged and read back by the ones that need it. A failed
model or gate is logged too and stops the run; what it kept from running is logged
as skipped.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rookery import schemas
from rookery.operators import checks, tables
from rookery.plans import gold, quality, silver
from rookery.sources import bronze

LAYERS = ("silver", "gold", "dq")
FLOW = "daily_batch"


@dataclass(frozen=True)
class Lake:
    """Where the landed data and the tables live."""

    landing: str
    tables: str

    def table(self, name: str) -> str:
        return f"{self.tables}/{name}"


@dataclass
class _Run:
    spark: SparkSession
    lake: Lake
    start: dt.date
    end: dt.date
    as_of: dt.date
    slack_months: int
    run_id: str

    # --- inputs -------------------------------------------------------------

    def games(self) -> DataFrame:
        path = self.lake.table("silver/clean_games")
        return tables.read_table(self.spark, path, schemas.CLEAN_GAMES)

    def _saved(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.lake.table(name))

    # --- models -------------------------------------------------------------

    def clean_games(self) -> int:
        raw = bronze.raw_games(self.spark, f"{self.lake.landing}/games")
        return tables.upsert_window(
            silver.clean_games(raw, self.start, self.end, self.slack_months),
            self.lake.table("silver/clean_games"),
            "game_id",
            "game_date",
            self.start,
            self.end,
            ["time_class", "eco_code", "player_white"],
        )

    def player_game_results(self) -> int:
        silver.player_game_results(self.games()).createOrReplaceTempView("player_game_results")
        return 0

    def openings_dim(self) -> int:
        return tables.rebuild(
            silver.openings_dim(self.games()), self.lake.table("silver/openings_dim")
        )

    def dim_players(self) -> int:
        landing = self.lake.landing
        players = silver.dim_players(
            bronze.raw_profiles(self.spark, f"{landing}/players/profiles"),
            bronze.raw_stats(self.spark, f"{landing}/players/stats"),
            bronze.raw_titled(self.spark, f"{landing}/titled"),
        )
        return tables.rebuild(
            players, self.lake.table("silver/dim_players"), cluster=["username"]
        )

    def daily_player_kpis(self) -> int:
        return tables.replace_window(
            gold.daily_player_kpis(self.games(), self.start, self.end),
            self.lake.table("gold/daily_player_kpis"),
            "game_date",
            self.start,
            self.end,
            ["username", "time_class"],
        )

    def opening_win_rates(self) -> int:
        rates = gold.opening_win_rates(self.games(), self._saved("silver/openings_dim"))
        return tables.rebuild(
            rates, self.lake.table("gold/opening_win_rates"), cluster=["eco_code", "time_class"]
        )

    def elo_trend_weekly(self) -> int:
        return tables.rebuild(
            gold.elo_trend_weekly(self.games()),
            self.lake.table("gold/elo_trend_weekly"),
            "week_start_date",
            ["username", "time_class"],
        )

    def time_control_meta(self) -> int:
        return tables.rebuild(
            gold.time_control_meta(self.games()), self.lake.table("gold/time_control_meta")
        )

    def player_cohorts(self) -> int:
        cohorts = gold.player_cohorts(
            self.games(), self._saved("silver/dim_players"), self.as_of
        )
        return tables.rebuild(cohorts, self.lake.table("gold/player_cohorts"))

    def dq_results(self) -> int:
        measured = quality.dq_results(
            self.games(), self.run_id, self.start, self.end, self.as_of
        )
        return tables.append(measured, self.lake.table("ops/dq_results"))

    def dq_gate(self) -> int:
        """Raise if a blocking check of this run failed."""
        results = tables.read_table(
            self.spark, self.lake.table("ops/dq_results"), schemas.DQ_RESULTS
        )
        checks.gate(results.filter(results.run_id == self.run_id))
        return 0


# Layer and model, in dependency order.
MODELS = [
    ("silver", "clean_games"),
    ("silver", "player_game_results"),
    ("silver", "openings_dim"),
    ("silver", "dim_players"),
    ("gold", "daily_player_kpis"),
    ("gold", "opening_win_rates"),
    ("gold", "elo_trend_weekly"),
    ("gold", "time_control_meta"),
    ("gold", "player_cohorts"),
    ("dq", "dq_results"),
    ("dq", "dq_gate"),
]


def _steps(layers: Iterable[str], gate_first: bool) -> list[tuple[str, str]]:
    order = ("silver", "dq", "gold") if gate_first else LAYERS
    chosen = set(layers)
    return [step for layer in order if layer in chosen for step in MODELS if step[0] == layer]


def _log(run: _Run, entries: list[dict]) -> None:
    rows = []
    for entry in entries:
        name, layer = entry["task_id"], entry["layer"]
        entry = {
            "run_id": run.run_id,
            "dag_id": FLOW,
            "target_table": f"{layer}.{name}" if layer != "dq" else "ops.dq_results",
            "window_start": run.start,
            "window_end": run.end,
            "logged_at": dt.datetime.now(dt.timezone.utc),
            **entry,
        }
        rows.append(tuple(entry.get(column) for column in schemas.RUN_LOG.fieldNames()))
    log = run.spark.createDataFrame(rows, schemas.RUN_LOG)
    tables.append(log.coalesce(1), run.lake.table("ops/pipeline_runs"))


def _logged(run: _Run, layer: str, name: str, model: Callable[[], int]) -> None:
    """Run one model and append its row to the run log, also when it fails."""
    started, clock = dt.datetime.now(dt.timezone.utc), time.monotonic()
    rows, error = None, None
    try:
        rows = model()
    except Exception as failure:  # the log must tell, then the run stops
        error = failure
    finished = dt.datetime.now(dt.timezone.utc)
    entry = {
        "task_id": name,
        "layer": layer,
        "status": "failed" if error else "success",
        "rows_written": rows,
        "duration_sec": time.monotonic() - clock,
        "error_message": str(error) if error else None,
        "started_at": started,
        "finished_at": finished,
    }
    _log(run, [entry])
    if error:
        raise error


def run_window(
    spark: SparkSession,
    lake: Lake,
    start: dt.date,
    end: dt.date,
    layers: Iterable[str] = LAYERS,
    as_of: dt.date | None = None,
    run_id: str | None = None,
    slack_months: int = 1,
    dry_run: bool = False,
    gate_first: bool = False,
) -> str:
    """Run the models of ``layers`` for an inclusive window; returns the run id.

    With the checks among the layers the run passes a gate, which raises if a
    blocking check failed: at its end or, with ``gate_first``, before the marts,
    so that those are only built from games that passed. ``dry_run`` only says
    what would run.
    """
    if start > end:
        raise ValueError("start must not be after end")
    layers = list(layers)
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    run_id = run_id or f"manual-{uuid.uuid4().hex[:12]}"
    steps = _steps(layers, gate_first)
    if dry_run:
        for layer, name in steps:
            print(f"[{layer}] {name} {start}..{end}")
        return run_id

    run = _Run(spark, lake, start, end, as_of or dt.date.today(), slack_months, run_id)
    for done, (layer, name) in enumerate(steps, 1):
        try:
            _logged(run, layer, name, getattr(run, name))
        except Exception:
            if steps[done:]:
                _log(
                    run,
                    [
                        {"task_id": later, "layer": of, "status": "skipped"}
                        for of, later in steps[done:]
                    ],
                )
            raise
    return run_id
