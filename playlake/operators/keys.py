"""Surrogate keys: sparse, hash and dense, in the rows or added as they are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import scratch_path

_PART, _POS, _OFFSET = "__part", "__pos", "__offset"
_POS_BITS = 33  # monotonically_increasing_id keeps the row's position in its lower 33 bits


def sparse_key(df: DataFrame, name: str) -> DataFrame:
    """Unique ids with gaps, at no cost; a second evaluation may number the rows differently."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def hash_key(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """A repeatable 64-bit hash of ``columns``.

    Among n distinct rows expect about n*n / 2**65 clashes: none at a billion rows, but
    thousands at a trillion. Where the key must be unique at that size use another mode.
    """
    return df.select(F.xxhash64(*columns).alias(name), "*")


def _store_with_position(df: DataFrame, path: str) -> DataFrame:
    row = F.monotonically_increasing_id()
    (
        df.withColumns({
            _PART: F.shiftright(row, _POS_BITS),
            _POS: row.bitwiseAND(F.lit((1 << _POS_BITS) - 1)),
        })
        .write.parquet(path, compression="zstd")
    )
    return df.sparkSession.read.parquet(path)


def dense_key(
    df: DataFrame,
    name: str,
    order: Sequence[str] | None = None,
    start: int = 1,
    scratch: str | None = None,
) -> DataFrame:
    """Consecutive ids from ``start``; without gaps, stored, so they never change.

    Each task numbers its own rows and an offset per task is added, so no task ever sees
    all the data: the only global step runs over one row count per task. The rows are
    written once to a scratch table, together with their task and position, because ids
    read twice must be the same even when a lost executor's work is redone.

    Without ``order`` the rows keep the layout they have and are not shuffled. With
    ``order`` ids follow that order; equal rows are told apart by their stored position,
    so the range split stays even when a third of the rows share one order value.

    The tables stay until their folder is deleted: one below ``spark.checkpoint.dir``, or
    ``scratch``, which the caller can delete once the result is written.
    """
    spark = df.sparkSession
    base = scratch or scratch_path(spark, "dense")
    stored = _store_with_position(df, f"{base}/numbered")
    if order is not None:
        arrival = [f"{_PART}_in", f"{_POS}_in"]
        by = [*order, *arrival]
        ranged = (
            stored.withColumnsRenamed({_PART: arrival[0], _POS: arrival[1]})
            .repartitionByRange(*by)
            .sortWithinPartitions(*by)
            .drop(*arrival)
        )
        stored = _store_with_position(ranged, f"{base}/ordered")
    sizes = stored.groupBy(_PART).agg(F.count("*").alias("n"))
    # One row per task that wrote the scratch table: a single-task window is enough.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PART, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_OFFSET))
    return (
        stored.join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col(_OFFSET) + F.col(_POS) + F.lit(start).cast("bigint"))
        .select(name, *df.columns)
    )


def write_numbered(df: DataFrame, path: str) -> None:
    """Write rows that ``read_numbered`` gives consecutive ids to: once, without a scratch table.

    The rows carry their task and their place in it; one small table below ``path`` says how many
    rows come before each task's. The files never change, so neither do the ids.
    """
    stored = _store_with_position(df, f"{path}/rows")
    sizes = stored.groupBy(_PART).agg(F.count("*").alias("n"))
    # one row per task that wrote
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PART, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_OFFSET))
    offsets.coalesce(1).write.parquet(f"{path}/offsets")


def read_numbered(spark: SparkSession, path: str, name: str, schema: T.StructType, start: int = 1) -> DataFrame:
    """The rows of ``write_numbered`` with their id, the first column ``name``, from ``start`` on.

    The table of offsets has one row per task that wrote; it is broadcast if its size allows that.
    """
    place = T.StructType([*schema.fields, T.StructField(_PART, T.LongType()), T.StructField(_POS, T.LongType())])
    offsets = T.StructType([T.StructField(_PART, T.LongType()), T.StructField(_OFFSET, T.LongType())])
    rows = spark.read.schema(place).parquet(f"{path}/rows")
    return (
        rows.join(spark.read.schema(offsets).parquet(f"{path}/offsets"), _PART)
        .withColumn(name, F.col(_OFFSET) + F.col(_POS) + F.lit(start).cast("bigint"))
        .select(name, *schema.fieldNames())
    )


def surrogate_key(
    df: DataFrame,
    name: str,
    mode: str = "sparse",
    *,
    columns: Sequence[str] | None = None,
    start: int = 1,
    scratch: str | None = None,
) -> DataFrame:
    """Add a surrogate key as the first column.

    ``columns`` are the hashed columns of mode ``hash`` and the row order of mode ``dense``,
    which keeps its tables below ``scratch``.
    """
    if mode == "sparse":
        return sparse_key(df, name)
    if mode == "hash":
        return hash_key(df, name, columns or df.columns)
    if mode == "dense":
        return dense_key(df, name, columns, start, scratch)
    raise ValueError(f"mode must be sparse, hash or dense, not {mode!r}")
