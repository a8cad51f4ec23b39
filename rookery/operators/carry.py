"""Carry the last observed value forward along an ordered key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def carry_forward(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    observed: dict[str, Column],
    block: Column,
) -> DataFrame:
    """Add one column per entry of ``observed``: its last non-NULL value so far.

    ``block`` cuts every key into consecutive stretches (a day or an hour of
    the order column). Rows are only ever gathered per (key, block), and what a
    block inherits from earlier ones comes from a one-row-per-block summary, so
    a key that holds a third of all rows is spread over its blocks. ``block``
    must not decrease along ``order``.
    """
    position = F.struct(*order)
    names = list(observed)
    cut = df.withColumns({"__block": block, **{f"__{n}": c for n, c in observed.items()}})

    by_block = [*keys, "__block"]
    inherited_window = (
        Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    )
    inherited = (
        cut.groupBy(*by_block)
        .agg(
            *[
                F.max_by(f"__{n}", F.when(F.col(f"__{n}").isNotNull(), position)).alias(f"__end_{n}")
                for n in names
            ]
        )
        .select(
            *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(by_block)],
            *[
                F.last(f"__end_{n}", ignorenulls=True).over(inherited_window).alias(f"__in_{n}")
                for n in names
            ],
        )
    )

    within = (
        Window.partitionBy(*by_block)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = cut.withColumns(
        {f"__{n}": F.last(f"__{n}", ignorenulls=True).over(within) for n in names}
    )
    same_block = [
        local[k].eqNullSafe(inherited[f"__key_{i}"]) for i, k in enumerate(by_block)
    ]
    return local.join(inherited, same_block, "left").select(
        *df.columns, *[F.coalesce(f"__{n}", f"__in_{n}").alias(n) for n in names]
    )
