"""Distinct rows, and one or more chosen rows per key.

The per-key operators are written as a ranking filtered to rank 1. Spark then prunes
each task's rows to the best per key *before* the shuffle, so a key holding a third of
all rows sends one row per task, not all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK, _KEY, _LATEST = "__rank", "__key", "__latest"


def distinct_rows(df: DataFrame, columns: Sequence[str | Column] | None = None) -> DataFrame:
    """Whole-row distinct, after an optional projection."""
    return (df.select(*columns) if columns else df).distinct()


def _best(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # The ranking sorts by the keys as listed; numbers first makes most comparisons cheap.
    kinds = dict(df.dtypes)
    listed = sorted(keys, key=lambda c: kinds.get(c) == "string")
    rank = F.row_number().over(Window.partitionBy(*listed).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)


def first_per_key(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The row of each key that arrived first; ``seq`` orders rows by arrival."""
    return _best(df, keys, [F.asc(c) for c in seq])


def last_per_key(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The row of each key that arrived last, as in a store where a write replaces its key."""
    return _best(df, keys, [F.desc(c) for c in seq])


def _all_latest(known: DataFrame, key: str, ts: Column) -> DataFrame:
    """Tied rows cannot be pruned to a few, so they must not meet in one task.

    The greatest times are counted from two columns and combined per task before their shuffle;
    the rows are joined with them by key and time. That join adaptive execution can split even
    where copies of a single row make up most of it.
    """
    latest = known.groupBy(F.col(key).alias(_KEY)).agg(F.max(ts).alias(_LATEST))
    return known.join(latest, (F.col(key) == F.col(_KEY)) & (ts == F.col(_LATEST))).select(known.columns)


def latest_per_key(
    df: DataFrame,
    key: str,
    ts: str | Column,
    *,
    ties: str = "all",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The rows of each key at its greatest ``ts``.

    ``ties='all'`` keeps every row at that time. ``ties='one'`` keeps one, the greatest by
    ``tie_break``, which should make the order total. Rows without a key or a time match
    nothing and are left out.
    """
    if ties not in ("all", "one"):
        raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")
    ts = F.col(ts) if isinstance(ts, str) else ts
    known = df.filter(F.col(key).isNotNull() & ts.isNotNull())
    if ties == "all":
        return _all_latest(known, key, ts)
    return _best(known, [key], [ts.desc(), *(F.desc(c) for c in tie_break)])
