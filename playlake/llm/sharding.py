"""Shards that all have the mixture of the whole: proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked. A row's fractional rank,
(rank + 1/2) / rows of the source, spreads every source evenly over the range from 0 to 1. Sorted
by it, any stretch of the rows holds the sources in proportion, and equal stretches are the shards.

DataFrame functions only. Ranks and positions are taken in two steps (see ``frames.running``):
neither a source with most of the rows nor the order over all rows passes one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import key_digits, running, shuffled_key, take

SHARDS = 24
SEED = "shard"
#: Fractional ranks are sorted in equal stretches, each on its own: so many, or more for more rows.
RANGES = 1024
ROWS_PER_RANGE = 1 << 20


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """Adds ``shard`` (from 0) and ``slot`` (from 0 without gaps in the shard) to ``docs``.

    Takes ``doc_id`` and ``source``. Shards differ by one row at most, and each holds every source
    in proportion. A null source is a source of its own. Null ids and repeated rows are rows like
    others (those without an id are shuffled by all their columns but maps); which of two equal rows comes first makes no difference. With fewer rows than shards
    some shards stay empty; an empty table gives an empty one. Input columns named ``shard`` or
    ``slot`` are replaced. Reruns agree as long as no two rows with the same id differ.
    """
    names = [n for n in docs.columns if n not in ("shard", "slot")]
    total = docs.count()
    ranges = max(RANGES, total // ROWS_PER_RANGE)
    table = take(docs, "doc_id", "source", rest="rest")
    plain = [f"rest.{f.name}" for f in table.schema["rest"].dataType if "map<" not in f.dataType.simpleString()]
    key = F.when(F.col("doc_id").isNull(), F.md5(F.concat_ws(":", F.lit(seed), F.xxhash64(*plain).cast("string")))).otherwise(
        shuffled_key(seed, "doc_id"))
    table = table.withColumn("key", key).withColumn("part", F.substring("key", 1, key_digits(total)))
    counts = take(docs, "source").groupBy(F.col("source").alias("of_source")).agg(F.count("*").alias("n"))
    ranked = (running(table, ["source"], "part", [F.col("key")], "rank")
              .join(counts, F.col("source").eqNullSafe(F.col("of_source")))
              .withColumn("fraction", (2 * F.col("rank") + 1) / (2 * F.col("n")))
              .withColumn("range", F.floor(F.col("fraction") * ranges)))
    placed = running(ranked, [], "range", [F.col("fraction"), F.col("source").asc_nulls_last(), F.col("key")], "place")
    at = {n: f"rest.c{docs.columns.index(n)}" for n in names}
    shard = F.expr(f"place * {shards} div {max(total, 1)}").cast("int")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (placed.withColumn("shard", shard).withColumn("slot", (F.col("place") - first).cast("long"))
            .select(*[F.col(at[n]).alias(n) for n in names], "shard", "slot"))
