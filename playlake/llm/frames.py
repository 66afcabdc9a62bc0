"""Small helpers the corpus operators share: safe column access, scratch tables, running sums."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..workspace import scratch_path

#: A word of the contracts: anything between ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def take(table: DataFrame, *names: str, rest: str | None = None, without: str = "") -> DataFrame:
    """The named columns only; with ``rest`` also all columns but one as one struct ``rest``.

    Columns are found by their exact name, so further columns whose names differ in case only,
    or equal an operator's own columns, are no hindrance. ``spread`` gives the struct back.
    """
    plain = table.toDF(*[f"c{i}" for i in range(len(table.columns))])
    kept = [F.col(f"c{table.columns.index(name)}").alias(name) for name in names]
    if rest is not None:
        kept.append(F.struct(*[c for c, n in zip(plain.columns, table.columns, strict=True) if n != without]).alias(rest))
    return plain.select(*kept)


def spread(rest: str, names: Sequence[str], **changed: Column) -> list[Column]:
    """The columns of a struct made by ``take``, with some of them changed."""
    return [changed.get(name, F.col(f"{rest}.c{i}")).alias(name) for i, name in enumerate(names)]


def in_bytes(texts: pa.Array, at_once: int = 256) -> Iterator[bytes | None]:
    """The texts of a column in UTF-8, one by one; few are copied at a time."""
    for low in range(0, len(texts), at_once):
        yield from texts.slice(low, at_once).cast(pa.large_binary()).to_pylist()


def give_back() -> None:
    """Return the memory that a Python worker's allocators would keep for its next batch or task."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def giving_back(group: Callable) -> Callable:
    """A function of groups that gives memory back after each one."""

    @wraps(group)
    def run(*given: object) -> pa.Table:
        made = group(*given)
        give_back()
        return made

    return run


@F.arrow_udf(BinaryType())
def compressed(texts: pa.Array) -> pa.Array:
    """Texts as Zstandard frames, which halves what is shuffled; null and empty ones as they are."""
    pack = zstandard.ZstdCompressor().compress
    packed = pa.array([pack(t) if t else t for t in in_bytes(texts)], pa.binary())
    give_back()
    return packed


def stored(table: DataFrame, name: str) -> DataFrame:
    """The table, written below ``spark.checkpoint.dir`` and read again.

    Computed once however often it is used, and it survives lost executors.
    """
    spark = table.sparkSession
    path = scratch_path(spark, name)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def shuffled_key(seed: str, *columns: str) -> Column:
    """A hexadecimal key that orders rows at random but alike in every run."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(":", F.lit(seed), *parts))


def key_digits(rows: int, per_part: int = 1 << 20) -> int:
    """How many leading digits of a ``shuffled_key`` cut so many rows into parts of a bounded size, on average."""
    digits = 2
    while 16 ** digits * per_part < rows:
        digits += 1
    return digits


def in_ranges(table: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The table, stored, with a number ``part`` that rises with ``order``: each part is a range of it.

    Stored, because ranges are sampled and may be others when they are worked out again."""
    return stored(table.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)


def running(table: DataFrame, keys: list[str], part: str, order: list[Column], name: str,
            value: Column | None = None) -> DataFrame:
    """Adds ``name``: the sum of ``value`` (default: the number of rows) over the rows of the
    same ``keys`` that come earlier in ``order``.

    ``part`` must rise with ``order``. Each part is summed on its own, and a table with one row
    per part gives the offset, so rows that share their keys still fill many tasks. Keys may be
    null.
    """
    value = F.lit(1) if value is None else value
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        table.groupBy(*keys, part).agg(F.sum(value).alias("in_part"))
        .withColumn("offset", F.coalesce(F.sum("in_part").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"o_{k}") for k in [*keys, part]], "offset")
    )
    inside = (Window.partitionBy(*keys, part).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    same = [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in [*keys, part]]
    joined = table.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return (joined.join(offsets, condition)
            .withColumn(name, F.col("offset") + F.col("inside"))
            .drop("inside", "offset", *[f"o_{k}" for k in [*keys, part]]))
