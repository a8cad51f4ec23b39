"""One input row to several output rows, in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def stack_rows(df: DataFrame, shared: list[str], variants: list[dict[str, Column]]) -> DataFrame:
    """Emit one row per entry of ``variants``, next to the ``shared`` columns.

    A union of two projections would scan the input twice; ``stack`` emits both
    rows while the input row is at hand.
    """
    names = list(variants[0])
    cells = [variant[name] for variant in variants for name in names]
    return df.select(*shared, F.stack(F.lit(len(variants)), *cells).alias(*names))
