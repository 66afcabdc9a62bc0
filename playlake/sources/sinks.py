"""Sinks: Parquet datasets, keyed tables, CSV, catalog tables and table versions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CONSOLIDATED_COLUMNS, Table
from ..workspace import scratch_path


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    dynamic: bool = False,
) -> None:
    """Write a Parquet dataset, optionally in one folder per value of ``partition_by``.

    Partitioned output is rebalanced first: adaptive execution gathers the rows of a
    small partition into one file and spreads a large one over many tasks, so a month
    with a third of all rows neither lands in one task nor in thousands of tiny files.
    ``overwrite`` replaces the whole dataset, or with ``dynamic`` only the partitions
    present in ``df``. Empty text is stored as NULL in a partition column.

    With ``sort_by`` rows are ranged by it instead, within ``partition_by``, and sorted: each file
    holds a narrow range, and a folder as many files as its ranges fall into.

    Files are compressed by zstd: a load writes all its rows two or three times.
    """
    if sort_by:
        order = [*partition_by, *sort_by]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if dynamic:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path, compression="zstd")


def write_keyed(
    df: DataFrame,
    table: Table,
    path: str,
    *,
    files: int | None = None,
    mode: str = "overwrite",
    bloom: Sequence[str] = (),
) -> None:
    """Write a keyed lookup table laid out for point reads on its key.

    Rows are range-partitioned and sorted by partition key, then clustering key. Each
    file covers a narrow key range, so a lookup skips nearly all files and row groups
    by their min/max, and a partition key with very many rows spreads over files.

    ``bloom`` names columns whose row groups get a Bloom filter, sized by their values. By it a
    lookup also skips row groups whose range has the value in it but which don't hold it: of a
    key that isn't there, or of a column that the rows aren't sorted by.

    Ranging samples its input in a job of its own, so the rows are stored before.
    """
    key = [*table.partition_key, *table.clustering_key]
    scratch = scratch_path(df.sparkSession, f"keyed-{table.name}")
    df.select(table.columns).write.parquet(scratch)
    rows = df.sparkSession.read.schema(table.schema).parquet(scratch)
    spread = rows.repartitionByRange(files, *key) if files else rows.repartitionByRange(*key)
    writer = spread.sortWithinPartitions(*key).write.mode(mode)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if bloom:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)
    delete_folder(df.sparkSession, scratch)


def write_consolidated(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """The consolidated event CSV: header, every field quoted, blanks kept."""
    (
        df.select(CONSOLIDATED_COLUMNS)
        .write.mode(mode)
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


# -- catalog tables ----------------------------------------------------------


def _qualified(database: str | None, name: str) -> str:
    return f"`{database}`.`{name}`" if database else f"`{name}`"


def drop_tables(spark: SparkSession, tables: Iterable[Table], database: str | None = None) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {_qualified(database, table.name)}")


def create_tables(
    spark: SparkSession,
    tables: Iterable[Table],
    database: str | None = None,
    location: str | None = None,
) -> None:
    """Create the missing tables; below ``location`` if given, else where the catalog keeps them."""
    for table in tables:
        place = f" LOCATION '{location.rstrip('/')}/{table.name}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_qualified(database, table.name)}"
            f" ({table.ddl()}) USING parquet{place}"
        )


def reset_tables(
    spark: SparkSession,
    tables: Iterable[Table],
    database: str | None = None,
    location: str | None = None,
) -> None:
    """Drop and recreate the tables. Files of a table with a ``location`` are kept by the drop."""
    tables = list(tables)
    drop_tables(spark, tables, database)
    create_tables(spark, tables, database, location)


def write_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    by: Sequence[str],
    buckets: int,
    *,
    sort: Sequence[str] = (),
    database: str | None = None,
) -> DataFrame:
    """Write a catalog table whose files are hash buckets of ``by``, sorted in themselves.

    Tables with the same buckets join on those columns, and group by them, without an exchange; with
    ``spark.sql.legacy.bucketedTableScan.outputOrdering`` also without a sort, as there is one file
    per bucket. The number of buckets is for the table's whole life, about its size over 1 GB. A key
    with a large share of the rows makes its bucket as large.
    """
    order = [*by, *(c for c in sort if c not in by)]
    (
        df.repartition(buckets, *by).write.mode("overwrite").format("parquet")
        .bucketBy(buckets, *by).sortBy(*order).option("path", path)
        .saveAsTable(_qualified(database, name))
    )
    return df.sparkSession.table(_qualified(database, name))


def insert_into(df: DataFrame, table: Table, database: str | None = None) -> None:
    """Append a query result to a catalog table, matching columns by name."""
    df.select(table.columns).write.insertInto(_qualified(database, table.name))


# -- versions ----------------------------------------------------------------
# A dataset cannot be overwritten while it is read. Read-modify-write therefore goes
# to a new folder; a reader takes the newest one that was completed.


def _version_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/version={version:012d}"


def _hadoop_conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _versions(spark: SparkSession, base: str) -> list[int]:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/version=*/_SUCCESS")
    done = pattern.getFileSystem(_hadoop_conf(spark)).globStatus(pattern) or []
    return sorted(
        int(status.getPath().getParent().getName().removeprefix("version=")) for status in done
    )


def current_version(spark: SparkSession, base: str, before: int | None = None) -> int | None:
    """The newest completed version below ``base``, or None; with ``before``, an earlier one."""
    found = [v for v in _versions(spark, base) if before is None or v < before]
    return found[-1] if found else None


def write_version(df: DataFrame, base: str, version: int) -> None:
    """Write one version of a dataset; writing it again replaces it."""
    df.write.mode("overwrite").parquet(_version_path(base, version))


def read_version(spark: SparkSession, base: str, table: Table, version: int) -> DataFrame:
    return spark.read.schema(table.schema).parquet(_version_path(base, version))


def expire_versions(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` completed versions."""
    for version in _versions(spark, base)[:-keep] if keep > 0 else []:
        delete_folder(spark, _version_path(base, version))


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that match a glob pattern, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(_hadoop_conf(spark)).globStatus(path) or []
    return sorted(status.getPath().toString() for status in found if status.isDirectory())


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files in a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(_hadoop_conf(spark)).getContentSummary(folder).getLength()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all its files, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(_hadoop_conf(spark)).delete(folder, True)
