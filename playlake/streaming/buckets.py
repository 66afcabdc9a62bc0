"""States in hash buckets: a batch rewrites the buckets it touches, and no others.

A table of states that batches are merged into lies in ``buckets`` folders by the hash of its key.
A batch reads the buckets that its own keys fall in, merges, and writes those buckets anew below a
folder of the batch. Of a large bucket it writes only its own states, beside the folders that are
there, until such additions have as many rows as what they are added to: so many batches rewrite a
bucket a few times, not once each. A small table per batch names the batches whose folders hold each
bucket now, with their rows; writing it is the commit. Readers of an earlier batch keep their files until
``expire_buckets``, and a batch that is replayed begins from the state before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import Table, layout
from ..sources import current_version, delete_folder, expire_versions, list_folders, read_version, write_version

BUCKETS = 256

#: A bucket with fewer rows is rewritten by every batch that touches it.
SMALL_ROWS = 10_000

_NAMES = Table("names", layout("""
    bucket int
    batch bigint
    buckets int
    n bigint
"""))


def _bucket(key: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket")


def _folder(base: str, batch: int, bucket: int) -> str:
    return f"{base}/data/version={batch:012d}/bucket={bucket}"


def _named(spark: SparkSession, base: str, version: int | None) -> dict[int, list[tuple[int, int, int]]]:
    """Batch, number of buckets and rows of each folder of a bucket in use, the oldest first."""
    named: dict[int, list[tuple[int, int, int]]] = {}
    if version is not None:
        for bucket, *folder in read_version(spark, f"{base}/names", _NAMES, version).orderBy("batch").collect():
            named.setdefault(bucket, []).append(tuple(folder))
    return named


def _due(folders: list[tuple[int, int, int]], added: int) -> bool:
    """Whether a bucket is to be rewritten: it is small, or additions have as many rows as its first folder."""
    sizes = [n for _, _, n in folders]
    return None in sizes or sizes[0] < max(SMALL_ROWS, sum(sizes[1:]) + added)


def merge_into_buckets(
    rows: DataFrame,
    base: str,
    batch: int,
    table: Table,
    merge: Callable[[DataFrame], DataFrame],
    buckets: int = BUCKETS,
) -> int:
    """Merge a batch into the states below ``base``; returns how many buckets it had rows for.

    ``merge`` reduces rows of ``table`` to one per key and must not depend on their order. The
    number of buckets is fixed by the first batch.
    """
    spark = rows.sparkSession
    now = _named(spark, base, current_version(spark, f"{base}/names", before=batch))
    for (_, n, _), *_ in now.values():
        if n != buckets:
            raise ValueError(f"{base} has {n} buckets, not {buckets}")
    # the batch, reduced and stored: it is read for its buckets, and then for its rows
    incoming = f"{base}/_incoming"
    merge(rows.select(table.columns)).select(*table.columns, _bucket(table.key, buckets)).write.mode("overwrite").parquet(incoming)
    fresh = spark.read.parquet(incoming)
    touched = _sizes(fresh)
    if touched:
        states, data = fresh, f"{base}/data/version={batch:012d}"
        due = [b for b, added in touched.items() if b in now and _due(now[b], added)]
        stored = [_folder(base, folder[0], b) for b in due for folder in now[b]]
        if stored:
            both = fresh.select(table.columns).unionByName(spark.read.schema(table.schema).parquet(*stored))
            states = merge(both).select(*table.columns, _bucket(table.key, buckets))
        states.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
        kind = T.StructType([*table.schema.fields, T.StructField("bucket", T.IntegerType())])
        written = _sizes(spark.read.schema(kind).parquet(data)) if stored else touched
        for bucket, n in written.items():
            before = [] if bucket in due else now.get(bucket, [])
            now[bucket] = [*before, (batch, buckets, n)]
    names = [(bucket, *folder) for bucket, folders in sorted(now.items()) for folder in folders]
    write_version(spark.createDataFrame(names, _NAMES.schema).coalesce(1), f"{base}/names", batch)
    return len(touched)


def _sizes(states: DataFrame) -> dict[int, int]:
    """The rows of each bucket; ``buckets`` numbers at most."""
    return {r.bucket: r["count"] for r in states.groupBy("bucket").count().collect()}


def read_buckets(
    spark: SparkSession,
    base: str,
    table: Table,
    up_to: int | None = None,
    merge: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The states as of the last merged batch, or of the last one up to a batch number.

    ``merge`` is that of ``merge_into_buckets``; it is needed for buckets that have additions.
    """
    version = current_version(spark, f"{base}/names", before=None if up_to is None else up_to + 1)
    if version is None:
        raise ValueError(f"no completed version below {base}")
    named = _named(spark, base, version)
    if not named:
        return spark.createDataFrame([], table.schema)

    def states(several: bool) -> DataFrame | None:
        folders = [_folder(base, f[0], b) for b, held in named.items() for f in held if (len(held) > 1) == several]
        return spark.read.schema(table.schema).parquet(*folders) if folders else None

    whole, parts = states(False), states(True)
    if parts is None:
        return whole
    if merge is None:
        raise ValueError(f"{base} has buckets with additions: merge must say how they are combined")
    merged = merge(parts).select(table.columns)
    return merged if whole is None else whole.unionByName(merged)


def expire_buckets(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Forget all but the newest ``keep`` batches, and delete the folders none of them names."""
    expire_versions(spark, f"{base}/names", keep)
    used, newest = set(), None
    while (version := current_version(spark, f"{base}/names", before=newest)) is not None:
        used |= {_folder("", f[0], bucket) for bucket, held in _named(spark, base, version).items() for f in held}
        newest = version
    for path in list_folders(spark, f"{base}/data/version=*/bucket=*"):
        name = path[path.rindex("/data/version="):]
        if name not in used:
            delete_folder(spark, path)
