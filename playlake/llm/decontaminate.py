"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over training text.

Every run of ``width`` words of a test item is a window; an item of fewer words is one window as a
whole. The hashes of all windows are a sorted set that each task holds. A document's words are
hashed once, the hashes of its windows are rolled from them, and a bitmap of the set's leading
bits sorts out nearly all. What is left is looked up in the set, and then compared word by word, so
hashes decide nothing. Words in a window found are hit; they, or their documents, are removed.

The set grows with the tests. It is counted first, and beyond ``SET_WINDOWS`` windows the items are
dealt into blocks, each with its own scan; what a block finds is stored before the next goes on.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .frames import spread, stored, take
from .terms import joined, terms
from .words import run_hashes

WIDTH = 10
#: Windows in one broadcast set: about 100 bytes of words each.
SET_WINDOWS = 1 << 20
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def n_terms(text: Column) -> Column:
    """The terms of a text (null: none), A-Z counted as a-z."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.regexp_count(F.translate(text, upper, upper.lower()), F.lit(TERM)), F.lit(0))


class Windows:
    """The hash set of the windows of some test items."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        owners: dict[bytes, set[int]] = defaultdict(set)
        self.names = sorted({name for name, _ in items if name is not None})
        number = {name: k for k, name in enumerate(self.names)}
        for name, text in items:
            data = (text or "").encode().lower()
            begin, end, _ = terms(data)
            words = [data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            for k in range(max(len(words) - width + 1, min(len(words), 1))):
                # an item without a name has windows, but nobody to count them for
                owners[b" ".join(words[k:k + width])].update([] if name is None else [number[name]])
        by_width: dict[int, list[bytes]] = defaultdict(list)
        for window in owners:
            by_width[window.count(b" ") + 1].append(window)
        self.sets = []
        for n, windows in sorted(by_width.items()):
            hashes = np.array([run_hashes(terms(w)[2], n)[0] for w in windows], np.uint64)
            order = np.argsort(hashes, kind="stable")
            shift = np.uint64(64 - max(12, len(windows).bit_length() + 6))
            some = np.zeros(1 << (64 - int(shift)), bool)
            some[(hashes >> shift).astype(np.int64)] = True
            self.sets.append((n, hashes[order], [windows[k] for k in order],
                              [sorted(owners[windows[k]]) for k in order], shift, some))

    def found(self, data: bytes, begin: np.ndarray, end: np.ndarray, words: np.ndarray,
              owner: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Which words are hit, and the items found by owner (the text a word is in)."""
        step = np.zeros(len(words) + 1, np.int64)
        items: dict[int, set[int]] = defaultdict(set)
        for n, hashes, windows, owners, shift, some in self.sets:
            if len(words) < n:
                continue
            rolled = run_hashes(words, n)
            maybe = np.flatnonzero(some[(rolled >> shift).astype(np.int64)])
            maybe = maybe[owner[maybe] == owner[maybe + n - 1]]
            at = np.searchsorted(hashes, rolled[maybe])
            at[at == len(hashes)] = 0
            same = hashes[at] == rolled[maybe]
            for i, k in zip(maybe[same].tolist(), at[same].tolist(), strict=True):
                window = b" ".join(data[a:b] for a, b in zip(begin[i:i + n].tolist(), end[i:i + n].tolist(), strict=True))
                while k < len(hashes) and hashes[k] == rolled[i]:  # equal hashes stand in a row
                    if windows[k] == window:
                        step[i] += 1
                        step[i + n] -= 1
                        items[int(owner[i])].update(owners[k])
                        break
                    k += 1
        return np.cumsum(step[:-1]) > 0, items


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return edge[0::2], edge[1::2]


def _scan(batches: Iterator[pa.RecordBatch], windows: Windows) -> Iterator[pa.RecordBatch]:
    """Adds what one block of items finds to what is known of each text."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        n, spans, items = [], [], [set(x or ()) for x in rows["items"].to_pylist()]
        before = rows["hit_words"].to_pylist()
        for first, data, starts in joined(batch.column("text")):
            begin, end, hashes = terms(data)
            owner = np.searchsorted(starts, begin, "right") - 1
            hit, found = windows.found(data, begin, end, hashes, owner)
            bounds = np.searchsorted(owner, np.arange(len(starts)))
            for k, numbers in found.items():
                items[first + k].update(windows.names[i] for i in numbers)
            for k in range(len(starts) - 1):
                a, b = int(bounds[k]), int(bounds[k + 1])
                mine = hit[a:b]
                for x, y in zip(*[iter(before[first + k] or ())] * 2, strict=True):
                    mine[x:y] = True
                n.append(b - a)
                if mine.any():
                    x, y = _runs(mine)
                    spans.append((np.stack([x, y], 1).ravel(), begin[a + x] - starts[k], end[a + y - 1] - starts[k]))
                else:
                    spans.append((np.zeros(0, np.int64),) * 3)
        longs = pa.list_(pa.int64())
        columns = {"n_words": pa.array(n, pa.int64()),
                   **{name: pa.array([s[j] for s in spans], longs) for j, name in enumerate(("hit_words", "span_starts", "span_ends"))},
                   "items": pa.array([sorted(x) for x in items], pa.list_(pa.string()))}
        yield pa.RecordBatch.from_arrays(
            [columns[name] if name in columns else batch.column(name) for name in batch.schema.names], names=batch.schema.names)


def contamination(docs: DataFrame, tests: DataFrame, width: int = WIDTH, set_windows: int = SET_WINDOWS,
                  rest: str | None = None) -> DataFrame:
    """What of each row of ``docs`` (``doc_id``, ``text``) stands in ``tests`` (``item_id``, ``text``) too.

    Returns ``doc_id``, ``text``, ``n_words``, ``hit_words`` (from and to of each run of hit words,
    in turn), ``span_starts`` and ``span_ends`` (the same runs in bytes of UTF-8), and ``items``: the
    ids of the items found, as sorted strings; with ``rest`` the whole input row as a struct.

    A null text has no words, in documents and items; an item without words has no window. An item
    with a null id hits words but isn't listed; items that share an id are listed once. Null and
    repeated ids of documents don't matter: every row is judged for itself. Without documents the
    result is empty, without items nothing is hit. Long texts are hashed in slices; an item is in one
    block as a whole. Further columns don't matter.
    """
    given = stored(take(tests, "item_id", "text")
                   .select(F.col("item_id").cast("string").alias("name"), "text",
                           F.greatest(n_terms(F.col("text")) - (width - 1), F.lit(1)).alias("windows")), "tests")
    blocks = max(1, -(-(given.agg(F.sum("windows").alias("n")).first()["n"] or 0) // set_windows))
    none = F.array().cast("array<long>")
    table = take(docs, "doc_id", "text", rest=rest).select(
        "*", F.lit(0).cast("long").alias("n_words"), none.alias("hit_words"), none.alias("span_starts"),
        none.alias("span_ends"), F.array().cast("array<string>").alias("items"))
    for block in range(blocks):
        if block:
            table = stored(table, "contamination")
        mine = given.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block)
        windows = Windows([(r.name, r.text) for r in mine.select("name", "text").collect()], width)  # a block
        table = table.mapInArrow(lambda batches, w=windows: _scan(batches, w), table.schema)
    return table


def decontaminated(docs: DataFrame, tests: DataFrame, width: int = WIDTH, documents: bool = False) -> DataFrame:
    """The rows of ``docs`` without what stands in ``tests``, all columns kept.

    Spans are cut from their first hit word to their last one, and ``n_chars`` is set to the new
    length; with ``documents`` rows with a hit go as a whole instead. Other cases as for
    ``contamination``: a null text stays null.
    """
    found = contamination(docs, tests, width, rest="rest")
    if documents:
        return found.where(F.size("items") + F.size("hit_words") == 0).select(*spread("rest", docs.columns))
    cut = F.size("span_starts") > 0
    changed = {"text": F.when(cut, _without("text", "span_starts", "span_ends")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kept = F.col(f"rest.c{docs.columns.index('n_chars')}")
        changed["n_chars"] = F.when(cut, F.length(changed["text"]).cast(docs.schema["n_chars"].dataType)).otherwise(kept)
    return found.select(*spread("rest", docs.columns, **changed))


@F.arrow_udf(StringType())
def _without(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Texts without spans of bytes, which begin and end with whole characters."""
    out = []
    for text, a, b in zip(texts.cast(pa.large_binary()).to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True):
        out.append(text and b"".join(text[x:y] for x, y in zip([0, *b], [*a, len(text)], strict=True)).decode())
    return pa.array(out, pa.string())
