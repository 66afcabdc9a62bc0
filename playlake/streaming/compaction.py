"""Compaction: the small files of many batches into files of a chosen size, while readers go on.

A dataset of batches has one ``batch=`` folder each. ``compact`` writes the batches up to a number
into one new folder beside them, and then names it, and the batches it stands for, in a small table
that is the commit. ``read_batches`` reads the named folders, and the ``batch=`` folders that none
of them stands for. A batch that is replayed after it was compacted changes its own folder only,
which nobody reads any more, so it counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import Table, layout
from ..sources import (
    current_version,
    delete_folder,
    expire_versions,
    folder_bytes,
    list_folders,
    read_version,
    write_version,
)

FILE_BYTES = 256 << 20

#: Rows that a task sorts in memory for one file: compressed ones may be many times as large there.
SORT_ROWS = 2_000_000

_BATCH = T.StructField("batch", T.LongType())
_PARTS = Table("parts", layout("""
    folder bigint
    first bigint
    last bigint
"""))


def append_batch(rows: DataFrame, path: str, batch: int) -> None:
    """Add a batch to a dataset as its own ``batch=`` folder; a replay replaces the folder."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def _parts(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """Folder, first and last batch of each compaction so far."""
    version = current_version(spark, f"{path}/_parts")
    if version is None:
        return []
    return [tuple(r) for r in read_version(spark, f"{path}/_parts", _PARTS, version).orderBy("folder").collect()]


def _folder(path: str, number: int) -> str:
    return f"{path}/_compacted/{number:012d}"


def read_batches(
    spark: SparkSession, path: str, table: Table, up_to: int | None = None
) -> DataFrame:
    """The rows of all batches of a dataset, compacted or not, or of those up to a batch number."""
    schema = T.StructType([*table.schema.fields, _BATCH])
    parts = _parts(spark, path)
    rows = spark.read.schema(schema).parquet(path)
    if parts:
        rows = rows.filter(F.col("batch") > parts[-1][2])
        rows = rows.unionByName(spark.read.schema(schema).parquet(*(_folder(path, p[0]) for p in parts)))
    if up_to is not None:
        rows = rows.filter(F.col("batch") <= up_to)
    return rows.select(table.columns)


def _batches(spark: SparkSession, path: str) -> dict[int, str]:
    return {int(f.rpartition("=")[2]): f for f in list_folders(spark, f"{path}/batch=*")}


def compact(
    spark: SparkSession,
    path: str,
    table: Table,
    up_to: int,
    *,
    order: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> int:
    """Compact the batches up to ``up_to`` that aren't yet; returns how many there were.

    ``up_to`` must be a batch that is done, such as the last one that ``load_activity_files`` has
    noted. With ``order`` the rows are ranged and sorted, so that scans can skip files by it, and a
    file has about ``SORT_ROWS`` rows at most, however well they compress. Only
    new batches are rewritten. Their own folders stay for readers that have begun, and go with the
    next compaction. One compaction of a dataset may run at a time.
    """
    parts = _parts(spark, path)
    done = parts[-1][2] if parts else -1
    folders = _batches(spark, path)
    todo = {b: f for b, f in folders.items() if done < b <= up_to}
    if not todo:
        return 0
    schema = T.StructType([*table.schema.fields, _BATCH])
    rows = spark.read.schema(schema).parquet(path).filter(F.col("batch").between(done + 1, up_to))
    files = max(1, -(-sum(folder_bytes(spark, f) for f in todo.values()) // file_bytes))
    if order:
        files = max(files, -(-rows.count() // SORT_ROWS))
        rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    else:
        rows = rows.coalesce(files)
    number = parts[-1][0] + 1 if parts else 0
    rows.write.mode("overwrite").parquet(_folder(path, number))
    named = [*parts, (number, min(todo), max(todo))]
    write_version(spark.createDataFrame(named, _PARTS.schema).coalesce(1), f"{path}/_parts", number)
    expire_versions(spark, f"{path}/_parts", keep=2)
    for batch, folder in folders.items():
        if batch <= done:
            delete_folder(spark, folder)
    return len(todo)
