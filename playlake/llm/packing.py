"""Packing documents into training sequences of several permitted lengths: best fit.

Documents are dealt into groups by a hash, and each group is packed for itself: pieces from large
to small, each into the open sequence it leaves the least room in. If it fits nowhere, a sequence
is opened, of the length that costs least per word: longer ones cost more per word, shorter ones
may be left half empty when too few small pieces remain to fill them. In the end every sequence
shrinks to the smallest permitted length that holds its contents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stored, take
from .mixing import n_words

LENGTHS = (512, 1024, 2048, 4096, 8192)
#: A sequence of n words costs n * (1 + n / QUADRATIC): attention grows with the square.
QUADRATIC = 16_384
GROUP_PIECES = 20_000
_COPIES = 1 << 16

PACKED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("first_word", pa.int64()),
                    ("n_words", pa.int64()), ("bin", pa.int64()), ("bin_size", pa.int64()), ("offset", pa.int64())])


def cost(length: int) -> float:
    return length * (1 + length / QUADRATIC)


def best_fit(sizes: list[int], lengths: tuple[int, ...] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Packs pieces given from large to small: the bin and the offset of each, and all bins' sizes."""
    lengths = tuple(sorted(lengths))
    room: dict[int, list[int]] = {}  # open bins by the room they have left
    rooms = 0  # bit r: some bin has r left
    filled: list[int] = []
    bins, offsets = [], []
    below = np.zeros(max(lengths) + 1, np.int64)  # words in pieces of at most so many words
    np.add.at(below, np.array(sizes, np.int64), np.array(sizes, np.int64))
    below = np.cumsum(below).tolist()
    remaining, open_room = sum(sizes), 0
    for size in sizes:
        fitting = rooms >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            which = room[left].pop()
            if not room[left]:
                rooms &= ~(1 << left)
        else:
            behind = remaining - size
            # what may still fill the gap: pieces that fit and have no room elsewhere
            left = min((n for n in lengths if n >= size), key=lambda n: cost(n) / (
                size + min(n - size, max(0, min(below[n - size], behind) - open_room))))
            which = len(filled)
            filled.append(0)
            open_room += left
        bins.append(which)
        offsets.append(filled[which])
        filled[which] += size
        remaining -= size
        open_room -= size
        if left > size:
            room.setdefault(left - size, []).append(which)
            rooms |= 1 << (left - size)
    return bins, offsets, [next(n for n in lengths if n >= f) for f in filled]


def _packed(rows: pa.Table, lengths: tuple[int, ...]) -> pa.Table:
    rows = rows.sort_by([("n_words", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                         ("tie", "ascending")])
    bins, offsets, sizes = best_fit(rows["n_words"].to_pylist(), lengths)
    at = np.array(bins, np.int64)
    group = np.int64(rows["group"][0].as_py()) << np.int64(32)
    return pa.Table.from_arrays(
        [rows[n].cast(PACKED.field(n).type) for n in ("doc_id", "piece", "first_word", "n_words")]
        + [pa.array(group + at), pa.array(np.array(sizes, np.int64)[at]), pa.array(offsets, pa.int64())],
        schema=PACKED)


def packed(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Where each document's words stand: ``doc_id``, ``piece``, ``first_word``, ``n_words``,
    ``bin``, ``bin_size`` (a permitted length) and ``offset`` in the bin.

    A text longer than the largest length is cut into pieces of it and a rest. Each word is in one
    bin, no bin holds more than its size, and no smaller permitted size would hold it. A null or
    blank text has no words: one row with ``n_words`` 0 and no bin. Null ids and repeated rows are
    packed like others. An empty table gives an empty one. Further columns don't matter.
    """
    longest = max(lengths)
    sized = stored(take(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")), "lengths")
    pieces = (sized.where("size > 0")
              .withColumn("piece", F.explode(F.sequence(F.lit(0), F.expr(f"cast((size - 1) div {longest} as int)"))))
              .withColumn("first_word", F.col("piece").cast("long") * longest)
              .withColumn("n_words", F.least(F.col("size") - F.col("first_word"), F.lit(longest).cast("long"))))
    count = sized.agg(F.sum(F.expr(f"(size + {longest - 1}) div {longest}")).alias("n")).first()["n"] or 0
    groups = max(1, -(-count // group_pieces))
    # copies of one row are counted and dealt one by one, so that not all are in one group
    counted = pieces.groupBy("doc_id", "piece", "first_word", "n_words", "tie").agg(F.count("*").alias("copies"))
    some = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {_COPIES}")))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(_COPIES), F.expr(f"copies - {_COPIES} * some")) - 1))
    dealt = (counted.withColumn("some", some).withColumn("each", each)
             .select("doc_id", "piece", "first_word", "n_words", "tie",
                     F.pmod(F.xxhash64("doc_id", "piece", "tie", F.expr(f"some * {_COPIES} + each")), F.lit(groups)).alias("group")))
    kinds = {pa.int32(): "int", pa.int64(): "long"}
    full = dealt.groupBy("group").applyInArrow(lambda t: _packed(t, lengths),
                                               ", ".join(f"{f.name} {kinds[f.type]}" for f in PACKED))
    blank = sized.where("size = 0").select(
        "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("first_word"), F.lit(0).cast("long").alias("n_words"),
        *[F.lit(None).cast("long").alias(n) for n in ("bin", "bin_size", "offset")])
    return full.unionByName(blank)
