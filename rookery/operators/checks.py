"""Declarative data-quality checks, measured in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    """A check counts violating rows; ``threshold`` is the allowed percentage.

    ``failed`` is an aggregate over the checked rows or, with ``from_side``, a
    column of the one-row side input.
    """

    name: str
    severity: str
    failed: Column
    threshold: float
    detail: str
    from_side: bool = False
    at_least_one: bool = False


def duplicate_excess(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows repeat an already present key.

    Counts per key are reduced in the map tasks first, so a key that holds a
    third of all rows costs one row per task in the shuffle.
    """
    return (
        df.groupBy(key)
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .filter(F.col("extra") > 0)
        .agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
    )


def measure(df: DataFrame, checks: list[Check], side: DataFrame | None = None) -> DataFrame:
    """One row per check: name, severity, failed and total rows, rate, verdict.

    Every check is an aggregate over the same single scan. ``side`` is an
    optional one-row DataFrame for measures that need another grain.
    """
    measures = [F.count(F.lit(1)).alias("__total")]
    measures += [
        c.failed.cast("bigint").alias(f"__{c.name}") for c in checks if not c.from_side
    ]
    one_row = df.agg(*measures)
    if side is not None:
        one_row = one_row.crossJoin(side)

    cells = []
    for check in checks:
        failed = check.failed if check.from_side else F.col(f"__{check.name}")
        total = F.col("__total")
        if check.at_least_one:
            total = F.greatest(total, F.lit(1))
        cells += [
            F.lit(check.name),
            F.lit(check.severity),
            failed,
            total.cast("bigint"),
            F.lit(float(check.threshold)),
            F.lit(check.detail),
        ]
    names = ["check_name", "severity", "failed_rows", "total_rows", "threshold_pct", "detail"]
    rows = one_row.select(F.stack(F.lit(len(checks)), *cells).alias(*names))

    percent = F.coalesce(
        F.try_divide(F.col("failed_rows").cast("double"), F.col("total_rows").cast("double")) * 100,
        F.lit(0.0),
    )
    return rows.select(
        "check_name",
        "severity",
        "failed_rows",
        "total_rows",
        F.round(percent, 4).alias("failed_pct"),
        "threshold_pct",
        (percent <= F.col("threshold_pct")).alias("passed"),
        "detail",
    )


class ChecksFailed(RuntimeError):
    """At least one blocking check did not pass."""


def failing(results: DataFrame, severity: str = "error") -> DataFrame:
    """Failed checks of one severity, worst first."""
    return (
        results.filter((F.col("severity") == severity) & ~F.col("passed"))
        .select("check_name", "failed_rows", "total_rows", "failed_pct", "detail")
        .orderBy(F.desc("failed_pct"), "check_name")
    )


def gate(results: DataFrame) -> None:
    """Raise when a blocking check failed. Reads one row per declared check."""
    rows = failing(results).collect()
    if rows:
        lines = [
            f"  - {r.check_name}: {r.failed_rows}/{r.total_rows} ({r.failed_pct}%): {r.detail}"
            for r in rows
        ]
        raise ChecksFailed(f"{len(rows)} data-quality check(s) failed:\n" + "\n".join(lines))
