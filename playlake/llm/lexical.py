"""Ranked lexical search by hashed max-sketches, with exact scores for what the sketches can't rule out.

The index has one row per document. A document's impact of a term grows with the term's count in
it alone, so the counts are what is folded: every term hashes to a coordinate, and a coordinate
holds the largest count that falls on it, as one byte that rounds up. A sketch has at least two
coordinates per different term. Beside it stands the document's profile, its sorted term hashes
and their counts.

A batch of queries is looked up in the sketches of many documents at once: the impacts at the
queries' coordinates, times the terms' weights, add up to more than any score the document can
have. Going down from the highest bound, documents are scored exactly from their profiles, until
the bound is below the k-th best score so far. Each task keeps its k best per query, and these are
ranked. Nothing is left out: a document is passed over only if its bound says so.

Terms are compared by 64-bit hashes. Queries are broadcast in blocks of at most ``BLOCK_TERMS`` terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .decontaminate import n_terms
from .frames import stored, take
from .terms import joined, terms

TOP = 20
BLOCK_TERMS = 1 << 20
DOCUMENTS_AT_ONCE = 1024
PARTS = 256  # that the tasks' results are first ranked in
#: Sketches per document, each with its own part of the terms' hashes for coordinates.
ROWS = 3
#: Coordinates of a sketch for each different term, at least.
COORDINATES = 4
LEAST_WIDTH = 64
#: Score: w * (UNIT * tf div (1000 * tf + 12 * m)) summed, with m = 100 - 25 + 25 * n * N div L.
UNIT = 1_000_000_000

#: Largest count of each code of a sketch: exact up to 15, then doubling.
COUNTS = np.array([*range(16), *(16 << k for k in range(1, 40))], np.int64)


def _codes(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(COUNTS, counts).astype(np.uint8)


def _coordinates(term: np.ndarray, row: int, width: np.ndarray) -> np.ndarray:
    """Where terms fall in a sketch of a width that is a power of two."""
    return ((term >> np.uint64(20 * row)) & (np.asarray(width) - 1).astype(np.uint64)).astype(np.int64)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketch and profile of every text; small batches, as sketches are wider than they are stored."""
    pack = zstandard.ZstdCompressor().compress
    for batch in batches:
        for number, data, starts in joined(batch.column("text")):
            begin, _, term = terms(data)
            owner = np.searchsorted(starts, begin, "right") - 1
            order = np.lexsort((term, owner))
            term, owner = term[order], owner[order]
            first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (owner[1:] != owner[:-1]))) if len(term) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(term)))
            n = np.bincount(owner, minlength=len(starts) - 1)
            term, owner = term[first], owner[first]
            different = np.bincount(owner, minlength=len(starts) - 1)
            width = np.maximum(LEAST_WIDTH, 1 << np.ceil(np.log2(np.maximum(COORDINATES * different, 1))).astype(np.int64))
            size = ROWS * width
            base = np.cumsum(size) - size
            sketch, code = np.zeros(int(size.sum()), np.uint8), _codes(count)
            for row in range(ROWS):
                np.maximum.at(sketch, base[owner] + row * width[owner] + _coordinates(term, row, width[owner]), code)
            a, b = np.cumsum(different) - different, np.cumsum(different)
            count = count.astype(np.uint32)
            sketches = [pack(sketch[x:x + w].tobytes()) for x, w in zip(base.tolist(), size.tolist(), strict=True)]
            hashes = [term[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            counts = [pack(count[x:y].tobytes()) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(number, len(n)), pa.array(n, pa.int64()), pa.array(sketches, pa.binary()),
                 pa.array(hashes, pa.binary()), pa.array(counts, pa.binary())],
                names=["doc_id", "n", "sketch", "terms", "counts"])


def index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (``doc_id``, ``text``): ``doc_id``, the number ``n`` of terms, ``sketch``, and
    the profile (``terms``, ``counts``), sketch and counts as Zstandard frames. Every row is in it; it depends on no query, and indexes of parts of
    a corpus are one by union. A null text has no terms. Further columns don't matter."""
    rows = take(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_indexed, f"doc_id {kind}, n long, sketch binary, terms binary, counts binary")


class Queries:
    """A block of queries: the different terms of all, and which each one has how often."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.ids = [i for i, _ in items]
        found = [Counter(terms((text or "").encode().lower())[2].tolist()) for _, text in items]
        self.vocabulary = np.array(sorted(set().union(*found)), np.uint64)
        self.of = [np.searchsorted(self.vocabulary, np.array(sorted(f), np.uint64)) for f in found]
        self.times = [np.array([f[h] for h in sorted(f)], np.int64) for f in found]
        self.weights: list[np.ndarray] = []
        self.corpus = (0, 0)

    def weigh(self, n_docs: int, length: int, having: dict[int, int]) -> None:
        """Sets the weights by the documents that have each term; documents with terms, and all terms."""
        self.corpus = (n_docs, length)
        weight = np.array([floor(1000 * log((2 * n_docs + 2) / (2 * having.get(k, 0) + 1)))
                           for k in range(len(self.vocabulary))], np.int64)
        self.weights = [weight[of] * times for of, times in zip(self.of, self.times, strict=True)]


def _having(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """How many documents of a task have each term of the vocabulary."""
    total = np.zeros(len(vocabulary) + 1, np.int64)
    shift = np.uint64(64 - max(12, len(vocabulary).bit_length() + 5))
    some = np.zeros(1 << (64 - int(shift)), bool)
    some[(vocabulary >> shift).astype(np.int64)] = True
    for batch in batches:
        for low in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
            rows = batch.column("terms").slice(low, DOCUMENTS_AT_ONCE).to_pylist()
            found = np.frombuffer(b"".join(rows), np.uint64)
            found = found[some[(found >> shift).astype(np.int64)]]
            at = np.searchsorted(vocabulary, found)
            total += np.bincount(at[vocabulary[np.minimum(at, len(vocabulary) - 1)] == found], minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["term", "docs"])


def _impacts(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return UNIT * counts // (1000 * counts + 12 * m)


class Search:
    """The best documents of each query that one task has seen."""

    def __init__(self, queries: Queries, top: int):
        self.queries, self.top = queries, top
        self.best: list[list[tuple]] = [[] for _ in queries.ids]  # (-score, id is null, id), best first
        self.scored = 0
        self.unpack = zstandard.ZstdDecompressor().decompress

    def look(self, ids: list, n: np.ndarray, sketches: np.ndarray, hashes: list[bytes], counts: list[bytes]) -> None:
        """Takes documents whose sketches, the rows of a matrix, are of one width."""
        q = self.queries
        n_docs, length = q.corpus
        m = 100 - 25 + 25 * n * n_docs // length
        width = sketches.shape[1] // ROWS
        codes = reduce(np.minimum, (sketches[:, row * width + _coordinates(q.vocabulary, row, width)] for row in range(ROWS)))
        by_code = _impacts(COUNTS[None, :int(codes.max(initial=0)) + 1], m[:, None])
        reach = np.take_along_axis(by_code, codes.astype(np.int64), axis=1)
        for k, (of, weights) in enumerate(zip(q.of, q.weights, strict=True)):
            bounds = reach[:, of] @ weights
            best = self.best[k]
            least = max(1, -best[-1][0]) if len(best) == self.top else 1
            open_ = np.flatnonzero(bounds >= least)
            for d in open_[np.argsort(-bounds[open_], kind="stable")].tolist():
                if len(best) == self.top and bounds[d] < -best[-1][0]:
                    break
                score = self.score(hashes[d], counts[d], m[d], q.vocabulary[of], weights)
                if score > 0:
                    self.keep(best, (-score, ids[d] is None, 0 if ids[d] is None else ids[d]))

    def score(self, hashes: bytes, counts: bytes, m: int, vocabulary: np.ndarray, weights: np.ndarray) -> int:
        self.scored += 1
        known = np.frombuffer(hashes, np.uint64)
        at = np.searchsorted(known, vocabulary)
        at[at == len(known)] = 0
        same = known[at] == vocabulary
        counted = np.frombuffer(self.unpack(counts), np.uint32)[at[same]].astype(np.int64)
        return int((weights[same] * _impacts(counted, m)).sum())

    def keep(self, best: list[tuple], entry: tuple) -> None:
        if len(best) < self.top or entry < best[-1]:
            best.append(entry)
            best.sort()
            del best[self.top:]


def _search(batches: Iterator[pa.RecordBatch], queries: Queries, top: int, item: pa.DataType) -> Iterator[pa.RecordBatch]:
    search, kind = Search(queries, top), pa.int64()
    for whole in batches:
        kind = whole.column("doc_id").type
        for low in range(0, whole.num_rows, DOCUMENTS_AT_ONCE):
            batch = whole.slice(low, DOCUMENTS_AT_ONCE)
            batch = batch.filter(pc.greater(batch.column("n"), 0))
            ids, n = batch.column("doc_id").to_pylist(), batch.column("n").to_numpy()
            hashes, counts = (batch.column(c).to_pylist() for c in ("terms", "counts"))
            sketches = [search.unpack(s) for s in batch.column("sketch").to_pylist()]
            width = np.fromiter(map(len, sketches), np.int64, len(sketches))
            for w in np.unique(width).tolist():
                rows = np.flatnonzero(width == w).tolist()
                matrix = np.frombuffer(b"".join(sketches[r] for r in rows), np.uint8).reshape(len(rows), w)
                search.look([ids[r] for r in rows], n[rows], matrix, [hashes[r] for r in rows], [counts[r] for r in rows])
    found = [(k, queries.ids[k], None if null else i, -score) for k, best in enumerate(search.best) for score, null, i in best]
    columns = list(zip(*found, strict=True)) or [()] * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), item, kind, pa.int64()), strict=True)],
        names=["query", "item_id", "doc_id", "score"])


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``search`` in an index of ``docs`` (``doc_id``, ``text``) that is made for it."""
    return search(stored(index(docs), "lexical-index"), items, top, block_terms)


def search(indexed: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """For each row of ``items`` (``item_id``, ``text``) the ``top`` documents of a written ``index``
    with the highest scores above 0: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Equal scores come by ascending ``doc_id``, null last. A null or empty text has no terms: such an item
    finds nothing, such a document isn't found or counted. Repeated documents are documents of
    their own, repeated items are searched for each. Without documents or items the result is empty.
    Texts are taken whole, however long. Further columns don't matter.
    """
    spark = indexed.sparkSession
    given = stored(take(items, "item_id", "text").withColumn("n", n_terms(F.col("text"))).where("n > 0"), "queries")
    blocks = max(1, -(-(given.agg(F.sum("n").alias("n")).first()["n"] or 0) // block_terms))
    corpus = indexed.agg(F.sum((F.col("n") > 0).cast("long")).alias("docs"), F.sum("n").alias("terms")).first()
    doc_kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((indexed, "doc_id"), (given, "item_id")))
    parts = []
    for block in range(blocks):
        mine = given.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = mine.select("item_id", "text").toArrow()  # a block of queries
        queries = Queries(list(zip(rows["item_id"].to_pylist(), rows["text"].to_pylist(), strict=True)))
        if not queries.ids or not corpus["terms"]:
            continue
        having = (indexed.select("terms")
                  .mapInArrow(lambda b, v=queries.vocabulary: _having(b, v), "term long, docs long")
                  .groupBy("term").agg(F.sum("docs").alias("docs")).collect())  # one row per term of the block
        queries.weigh(corpus["docs"], corpus["terms"], {r.term: r.docs for r in having})
        found = indexed.mapInArrow(lambda b, q=queries, t=rows.schema.field("item_id").type: _search(b, q, top, t),
                                   f"query long, item_id {item_kind}, doc_id {doc_kind}, score long")
        # every task has its best; they are ranked in two rounds, as there may be very many tasks
        by_score = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        for keys in (["query", "part"], ["query"]):
            place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by_score))
            found = found.withColumn("part", F.spark_partition_id() % PARTS) if "part" in keys else found
            found = found.withColumn("rank", place).where(F.col("rank") <= top)
        parts.append(found.select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {doc_kind}, score long")
    return reduce(DataFrame.unionAll, parts)
