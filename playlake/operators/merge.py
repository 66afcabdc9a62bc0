"""Upserts and guarded appends over immutable datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import first_per_key


def merge_fields(
    df: DataFrame,
    keys: Sequence[str],
    *,
    first: Mapping[str, Sequence[str]],
    last: Mapping[str, Sequence[str]],
) -> DataFrame:
    """One row per key, some columns from its first row and others from its last.

    ``first`` and ``last`` map an ordering column (it may be a struct) to the columns taken
    in that order; no ordering column may be used twice. They are kept, as the lowest and
    highest seen, so the result can be merged again with other rows, in any order and as
    often as one likes. These are plain min and max aggregates over ``(order, values)``,
    combined map-side before the shuffle.
    """
    picked = df.groupBy(*keys).agg(
        *(F.min(F.struct(o, *cols)).alias(f"__{o}") for o, cols in first.items()),
        *(F.max(F.struct(o, *cols)).alias(f"__{o}") for o, cols in last.items()),
    )
    parts = [*first.items(), *last.items()]
    return picked.select(
        *keys,
        *(F.col(f"__{o}.{c}").alias(c) for o, cols in parts for c in cols),
        *(F.col(f"__{o}.{o}").alias(o) for o, _ in parts),
    )


def insert_absent(
    existing: DataFrame | None, batch: DataFrame, keys: Sequence[str], seq: Sequence[str]
) -> DataFrame:
    """The rows of ``batch`` to append: the first of each key that ``existing`` does not hold."""
    fresh = first_per_key(batch, keys, seq)
    return fresh if existing is None else fresh.join(existing.select(*keys), [*keys], "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise ValueError if a key occurs more than once; shows at most five of them."""
    found = duplicate_keys(df, keys).limit(5).collect()
    if found:
        raise ValueError(f"duplicate {'/'.join(keys)}: {[tuple(r)[:-1] for r in found]}")


def append_unique(
    existing: DataFrame | None, batch: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """``batch``, checked to keep ``keys`` unique within itself and against ``existing``."""
    both = batch.select(*keys)
    if existing is not None:
        both = both.unionByName(existing.select(*keys))
    assert_unique(both, keys)
    return batch
