"""Costly expressions that must not be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def evaluate_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters and projections read but never repeat.

    The optimizer copies ordinary columns into every filter above them, and a
    parse of a long text would then run once per use. It does not look through
    an explode, so the one-element array keeps it at one run per row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
