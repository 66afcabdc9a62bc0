"""Document fingerprints: the smallest k hashes of a document's word shingles.

A fingerprint of a text is a fingerprint of the set of its shingles. Fingerprints of parts merge
into the one of the whole (the smallest k of both), and two of them estimate how much their texts
resemble each other, how much of one is contained in the other, and how many shingles each has.

As text a fingerprint is the base64 form of its hashes, five bytes each, smallest first.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from .frames import compressed, take
from .words import run_hashes, word_hashes

K = 128
SHINGLE = 5
_BITS = 40


def sketch(text: bytes, k: int = K, width: int = SHINGLE) -> np.ndarray:
    """The k smallest different shingle hashes of a text, in order; none if it has no words."""
    hashes = run_hashes(word_hashes(text), width) >> np.uint64(64 - _BITS)
    if len(hashes) > 8 * k:  # most of a long text is too large: look at the small end first
        few = np.unique(np.partition(hashes, 4 * k)[:4 * k])
        if len(few) >= k:
            return few[:k]
    return np.unique(hashes)[:k]


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The fingerprint of two texts' shingles together."""
    return np.unique(np.concatenate([a, b]))[:k]


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of different shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * float(1 << _BITS) / (float(a[k - 1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated shingles in both by shingles in either; two texts without any are alike."""
    both = merged(a, b, k)
    if not len(both):
        return 1.0
    return float(np.count_nonzero(np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True))) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first text's shingles that the second has, too."""
    if not len(a):
        return 1.0
    common = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return min(1.0, common / distinct_shingles(a, k))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    wide = np.zeros((len(raw := base64.b64decode(text)) // 5, 8), np.uint8)
    wide[:, 3:] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.view(">u8").ravel().astype(np.uint64)


@F.arrow_udf(StringType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """The fingerprint of each text; a null or blank one has an empty fingerprint."""
    return pa.array([to_text(sketch(t)) if t else "" for t in texts.cast(pa.large_binary()).to_pylist()], pa.string())


@F.arrow_udf(StringType())
def merge(a: pa.Array, b: pa.Array) -> pa.Array:
    """The fingerprint of two parts together."""
    return pa.array([to_text(merged(from_text(x or ""), from_text(y or "")))
                     for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.string())


def _measure(of):  # noqa: ANN001, ANN202
    @F.arrow_udf(DoubleType())
    def measure(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([of(from_text(x or ""), from_text(y or ""))
                         for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.float64())

    return measure


likeness = _measure(resemblance)
contained = _measure(containment)


@F.arrow_udf(DoubleType())
def shingle_count(a: pa.Array) -> pa.Array:
    """Estimated number of different shingles of each fingerprint."""
    return pa.array([distinct_shingles(from_text(x or "")) for x in a.to_pylist()], pa.float64())


def _bucketed(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows with the range of ids they lie in, largest ids first; the first row of a range also
    stands at the end of the range before, as ``guest``. Rows without an id follow in as many
    ranges of their texts' hashes."""
    slim = docs.select("doc_id").where("doc_id is not null")
    cuts = [c for c in (slim.select(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)],
                                                        max(10_000, 10 * buckets)).alias("cuts")).first()["cuts"] if buckets > 1 else None) or [] if c is not None]
    bounds = np.unique(np.array(cuts, np.int64))
    last = len(bounds)  # range i holds ids from bounds[i - 1] + 1 to bounds[i]

    def ranges(ids: pa.Array, ties: pa.Array) -> np.ndarray:
        # null ids come after all others, by the leading bits of their ties
        found = len(bounds) - np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), "left")
        rising = (ties.to_numpy(zero_copy_only=False) >> 32) + (1 << 31)
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), last + 1 + ((rising * buckets) >> 32), found)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array, ties: pa.Array) -> pa.Array:
        return pa.array(ranges(ids, ties), pa.int32())

    # one row per range
    tied = docs.select("doc_id", F.xxhash64("text").alias("tie"))
    tops = tied.groupBy(range_of("doc_id", "tie").alias("range")).agg(F.max("doc_id").alias("head"), F.min("tie").alias("tie"))
    heads = {r["range"]: r["head"] if r["head"] is not None else ("tie", r["tie"]) for r in tops.collect()}
    order = sorted(heads)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # the first comes after the last

    @F.arrow_udf("array<struct<range:int,guest:boolean>>")
    def places(ids: pa.Array, ties: pa.Array) -> pa.Array:
        rows = []
        for i, t, r in zip(ids.to_pylist(), ties.to_pylist(), ranges(ids, ties).tolist(), strict=True):
            here = [{"range": r, "guest": False}]
            if heads[r] == (("tie", t) if i is None else i):
                here.append({"range": before[r], "guest": True})
            rows.append(here)
        return pa.array(rows, pa.list_(pa.struct([("range", pa.int32()), ("guest", pa.bool_())])))

    return (docs.select("doc_id", compressed("text").alias("packed"), F.xxhash64("text").alias("tie"),
                        places("doc_id", F.xxhash64("text")).alias("places"))
            .select("doc_id", "packed", "tie", F.explode("places").alias("at"))
            .select("doc_id", "packed", "tie", "at.range", "at.guest"))


FINGERPRINTED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                           ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                           ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compared(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows in, each row that is no guest out, compared with the row that follows it."""
    rows: list[tuple] = []
    waiting = None

    def compared(doc: tuple, following: tuple) -> tuple:
        doc_id, text, own = doc
        _, next_text, other = following
        keep = len(text) - len(text) // 2
        edited = (text[:keep] + next_text[:len(text) // 2]).encode()
        changed = sketch(edited, k, width)
        return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), to_text(own), to_text(changed),
                resemblance(own, changed, k), resemblance(own, other, k))

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FINGERPRINTED, strict=True)],
                                          schema=FINGERPRINTED)

    place, unpack = None, zstandard.ZstdDecompressor().decompress
    for part in batches:
        for doc_id, packed, where, guest in zip(*[c.to_pylist() for c in part.columns], strict=True):
            if where == place and waiting is None:
                continue  # a further copy of the guest
            data = unpack(packed) if packed else b""
            this = (doc_id, data.decode(), sketch(data, k, width))
            if where == place:
                rows.append(compared(waiting, this))
            place, waiting = where, None if guest else this
            if len(rows) >= 1000:
                yield batch()
    if rows:
        yield batch()


def compare_with_edited(docs: DataFrame, k: int = K, width: int = SHINGLE, ranges_per_task: int = 4) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    The edited text is the text with its last half of code points (rounded down) replaced by the
    first as many (or all) of the next document; next is the one with the next smaller ``doc_id``,
    and after the last comes the first. Returns ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next`` (resemblance to the
    edited and to the next text).

    Rows are dealt into ranges of ids, and each range gets the first row of the next one as a
    guest, so the texts move once and no order over all rows is needed. A task passes through its
    ranges row by row, so their number goes by the tasks (``spark.sql.shuffle.partitions``), not by
    the rows; the driver holds two numbers per range, as a range partitioner does. A null text counts as
    empty. Null ids come last, repeated ids after each other in the order of their texts' hashes.
    A single document is its own next. An empty table gives an empty one. Further columns don't
    matter.
    """
    spark = docs.sparkSession
    table = take(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = ranges_per_task * parts
    sorted_rows = (_bucketed(table, buckets).repartition(parts, "range")
                   .sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), "tie")
                   .select("doc_id", "packed", "range", "guest"))
    types = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    return sorted_rows.mapInArrow(lambda b: _compared(b, k, width),
                                  ", ".join(f"{f.name} {types[f.type]}" for f in FINGERPRINTED))
