"""Values of the previous period on every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def with_previous(
    periods: DataFrame, keys: list[str], period: str, previous: dict[str, str]
) -> DataFrame:
    """Add the previous period's values: ``{new column: source column}``.

    Meant for rows already aggregated per (key, period): a key then has at most
    as many rows as the calendar has periods.
    """
    window = Window.partitionBy(*keys).orderBy(period)
    return periods.withColumns(
        {name: F.lag(source).over(window) for name, source in previous.items()}
    )


def week_of(day: str) -> object:
    """Monday of the week a date falls in."""
    return F.date_trunc("week", F.col(day)).cast("date")


def whole_weeks(later: str, earlier: str) -> object:
    """Weeks between two Mondays."""
    return F.expr(f"datediff({later}, {earlier}) div 7")
