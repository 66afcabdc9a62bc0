"""Most frequent keys, overall and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _counts(df: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Rows per key, or the sum of ``count`` where ``df`` holds rows counted before."""
    total = F.sum(count) if count in df.columns else F.count("*")
    return df.groupBy(*keys).agg(total.alias(count))


def top_k(df: DataFrame, keys: Sequence[str], k: int, count: str = "plays") -> DataFrame:
    """The ``k`` most frequent keys with their row count, the smaller key first among equals.

    If ``df`` already has a ``count`` column, its values are added up instead.
    """
    return (
        _counts(df, keys, count)
        .orderBy(F.desc(count), *keys)
        .limit(k)
    )


def top_k_per_group(
    df: DataFrame, group: Sequence[str], keys: Sequence[str], k: int, count: str = "plays"
) -> DataFrame:
    """The ``k`` most frequent keys of every group, with their 1-based ``pos``.

    Rows are counted map-side; each task then passes on at most ``k`` keys per group, so a
    dominant group costs its final task no more than k rows from every other task.
    """
    counts = _counts(df, [*group, *keys], count)
    order = Window.partitionBy(*group).orderBy(F.desc(count), *keys)
    return counts.withColumn("pos", F.row_number().over(order)).filter(F.col("pos") <= k)
