"""Most frequent label per key, with totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def label_counts(df: DataFrame, key: str, label: str) -> DataFrame:
    """Rows per (key, label), NULL keys and labels left out."""
    known = df.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(key, label).agg(F.count(F.lit(1)).alias("rows"))


def most_frequent_label(df: DataFrame, key: str, label: str) -> DataFrame:
    """One row per key: the commonest label (ties: first alphabetically).

    ``total_rows`` counts the key's rows and ``label_variants`` its labels. All
    three are aggregates over the label counts, so a key with very many labels
    is reduced inside the map tasks and never gathered or sorted as a group.
    """
    best = F.struct((-F.col("rows")).alias("fewest"), F.col(label))
    return (
        label_counts(df, key, label)
        .groupBy(key)
        .agg(
            F.min_by(F.col(label), best).alias(label),
            F.sum("rows").alias("total_rows"),
            F.count(F.lit(1)).alias("label_variants"),
        )
    )
