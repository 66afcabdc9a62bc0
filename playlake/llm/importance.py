"""Quality selection by importance resampling over hashed n-grams.

Two bag-of-n-grams models are counted: one over all raw documents, one over documents labelled
good. Words and word pairs are hashed into ``BUCKETS`` buckets, so a model is one number per
bucket. A document's log weight is how much likelier the target model makes its n-grams than the
raw one. Adding Gumbel noise and keeping the largest values samples documents without replacement
in proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .frames import stored, take
from .words import run_hashes, word_hashes

BUCKETS = 1 << 16
#: The target model is fitted on so many labelled documents at most, those with the smallest hashes.
MAX_LABELLED = 20_000
KEEP = 0.8
SMOOTHING = 1.0
SEED = 7


def buckets_of(text: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every word and word pair of a text; A-Z count as a-z."""
    words = word_hashes(text.lower())
    pairs = run_hashes(words, 2) if len(words) > 1 else words[:0]
    return (np.concatenate([words, pairs]) % np.uint64(buckets)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for batch in batches:
        texts, goods = batch.column(0).cast(pa.large_binary()).to_pylist(), batch.column(1).to_pylist()
        for text, is_good in zip(texts, goods, strict=True):
            if text:
                counts = np.bincount(buckets_of(text, buckets), minlength=buckets)
                raw += counts
                if is_good:
                    good += counts
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(good[at])],
                                     names=["bucket", "raw", "good"])


def log_ratios(docs: DataFrame, good_ids: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log of target over raw probability for every bucket, counted over all of ``docs``.

    ``good_ids`` (``doc_id``) name the target documents; at most ``MAX_LABELLED`` are used.
    """
    chosen = (take(good_ids, "doc_id").where("doc_id is not null").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
              .select(F.col("doc_id").alias("good_id")))
    # at most MAX_LABELLED ids: safe to broadcast
    marked = (take(docs, "doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("good_id"), "left")
              .select("text", F.col("good_id").isNotNull().alias("good")))
    rows = (marked.mapInArrow(lambda b: _counted(b, buckets), "bucket long, raw long, good long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect())
    raw, good = np.full(buckets, SMOOTHING), np.full(buckets, SMOOTHING)  # one number per bucket
    for r in rows:
        raw[r["bucket"]] += r["raw"]
        good[r["bucket"]] += r["good"]
    return np.log(good / good.sum()) - np.log(raw / raw.sum())


def log_weight(text: Column, ratios: np.ndarray) -> Column:
    """A document's log weight, the sum over all its n-grams; 0 for a null or blank text."""

    @F.arrow_udf(DoubleType())
    def weigh(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.cast(pa.large_binary()).to_pylist():
            out.append(float(ratios[buckets_of(t, len(ratios))].sum()) if t else 0.0)
        return pa.array(out, pa.float64())

    return weigh(text)


def gumbel(seed: int, *columns: str) -> Column:
    """Gumbel noise that is the same in every run, from a hash of the columns."""
    even = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) + 0.5) / float(1 << 53)
    return -F.log(-F.log(even))


def threshold(table: DataFrame, column: str, wanted: int, few: int = 4096, bins: int = 64) -> tuple:
    """The ``wanted``-th largest value of a column, and how many rows with it are among the ``wanted`` largest.

    Each round counts the rows above some quantiles of what is left and goes on between two of them,
    until one of them is the value or ``few`` rows are left, which are looked at.
    """
    inside, value = table.select(F.col(column).alias("v")), F.col("v")
    while inside.count() > few:
        quantiles = inside.agg(F.percentile_approx("v", [i / bins for i in range(1, bins)], 1000).alias("q")).first()["q"]
        cuts = sorted(set(quantiles), reverse=True)
        counts = inside.agg(*[F.count_if(value >= c).alias(f"from{i}") for i, c in enumerate(cuts)],
                            *[F.count_if(value > c).alias(f"above{i}") for i, c in enumerate(cuts)]).first()
        upper = None
        for i, c in enumerate(cuts):
            if counts[f"from{i}"] >= wanted:
                if counts[f"above{i}"] < wanted:
                    return c, wanted - counts[f"above{i}"]
                inside = inside.where(value > c)
                break
            upper = i
        if upper is not None:
            inside = inside.where(value < cuts[upper])
            wanted -= counts[f"from{upper}"]
    values = sorted((r["v"] for r in inside.collect()), reverse=True)  # few
    found = values[wanted - 1]
    return found, wanted - sum(v > found for v in values)


def resampled(docs: DataFrame, good_ids: DataFrame, keep: float = KEEP, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``log_weight``, ``score`` (with noise) and ``kept`` of every row of ``docs``.

    Exactly the ``keep`` share of the rows (rounded down) with the largest scores is kept; of rows with
    equal scores, which are repeated rows as a rule, any may be. Null and blank texts have weight 0, as
    if neither model knew better. Rows without an id take their noise from a seeded random number. Without
    good ids all weights follow the raw model alone. An empty table gives an empty one. Texts count
    whole, however long. Further columns don't matter.
    """
    ratios = log_ratios(docs, good_ids)
    scored = stored(take(docs, "doc_id", "text")
                    .select("doc_id", log_weight(F.col("text"), ratios).alias("log_weight"))
                    .withColumn("by", F.when(F.col("doc_id").isNull(), F.rand(seed)))
                    .withColumn("score", F.col("log_weight") + gumbel(seed, "doc_id", "by"))
                    .withColumn("row", F.monotonically_increasing_id()).drop("by"), "scored")
    wanted = int(scored.count() * keep)
    kept = F.lit(False)
    if wanted:
        least, ties = threshold(scored, "score", wanted)
        equal = scored.where(F.col("score") == least)
        first = threshold(equal, "row", ties)[0] if ties < equal.count() else 0
        kept = (F.col("score") > least) | ((F.col("score") == least) & (F.col("row") >= first))
    return scored.select("doc_id", "log_weight", "score", kept.alias("kept"))
