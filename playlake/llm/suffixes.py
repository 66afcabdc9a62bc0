"""Removal of byte passages that other documents hold already, by column-wise suffix sorting.

The documents are cut into short overlapping strings, and the strings are brought together so
that every passage of ``span`` bytes meets all its equals in one group:

1. Every window of ``span`` bytes has an anchor, the smallest hash of the pieces of ``PIECE`` bytes in it.
   Equal windows have equal anchors, and neighbouring windows mostly share one.
2. Documents are dealt into chunks. A chunk lists its anchors once each; an anchor seen in one
   document only can't belong to a repeated passage and goes no further.
3. For the other anchors a chunk cuts the runs of windows that share the anchor into strings,
   each different string once, with the smallest document that holds it.
4. The strings of a group are sorted column by column: each round puts one more symbol of every
   string, from its end to its start, into the Burrows-Wheeler transform of the collection and
   updates the common prefixes next to the new suffixes. Suffixes with ``span`` bytes in common
   are one passage, and the smallest document of a passage is its owner.
5. Each chunk looks its windows up and drops what a smaller document owns.

The transform, the common prefixes and the suffix numbers are plain arrays that every round
reads and writes in order. A group stays small, because an anchor with too many strings is cut
into single windows that are spread by their own hash; so the arrays are kept in memory where
the method on paper keeps files.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .frames import compressed, give_back, giving_back, in_bytes, spread, take

SPAN = 50
PIECE = 24  # bytes hashed for an anchor
CHUNK_BYTES = 4 << 20  # text of a chunk, at least
LARGEST_CHUNK = 256 << 20
RUN = 32  # windows of a string; so it has at most span + 31 columns
SLICE = 1 << 19  # windows that are hashed at once
HOT = 50_000  # different runs of an anchor from which its windows are spread singly
MANY = 64  # runs of an anchor in a chunk from which they are looked at
STEPS = 8  # the number of runs is rounded up to a power of the 8th root of 2
SORTED_AT_ONCE = 4_096  # strings that are sorted together, but for larger groups

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                               0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                               0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every piece of ``width`` bytes; pieces are joined in doubling sizes."""
    level = {1: (data.astype(np.uint64) + np.uint64(1)) * _MIX[0]}
    size, step = 1, 1
    while 2 * size <= width:
        h = level[size]
        h = h[:-size] * _MIX[step % 8] + h[size:]
        h ^= h >> np.uint64(29)
        size, step = 2 * size, step + 1
        level = {size: h}
    h = level[size]
    if size < width:
        h = h[:size - width] * _MIX[7] + h[width - size:]
        h ^= h >> np.uint64(29)
    h = (h ^ (h >> np.uint64(32))) * _MIX[3]
    return h ^ (h >> np.uint64(32))


def _anchors(data: np.ndarray, span: int) -> np.ndarray:
    """For every window of ``span`` bytes the smallest hash of a piece in it; its low byte is 0."""
    piece = min(PIECE, span)
    return _lowest(_hashes(data, piece), span - piece + 1)


def _lowest(low: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` hashes in a row; its low byte is 0."""
    size = 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[:size - width], low[width - size:])
    return (low & ~np.uint64(255)).view(np.int64)


def _anchors_at(data: bytes, starts: np.ndarray, span: int) -> np.ndarray:
    """The anchors of some windows, given in order."""
    whole = np.frombuffer(data, np.uint8)
    found = [np.zeros(0, np.int64)]
    for low in range(0, len(whole) - span + 1, SLICE):
        a = _anchors(whole[low:low + SLICE + span - 1], span)
        i, j = np.searchsorted(starts, (low, low + SLICE), "left")
        found.append(a[starts[i:j] - low])
    return np.concatenate(found)


def _hashes_at(data: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """The hash of the piece of ``width`` bytes at each place; only slices that hold some are hashed."""
    order = np.argsort(places, kind="stable")
    placed, found = places[order], np.empty(len(places), np.int64)
    i = 0
    while i < len(placed):
        low = int(placed[i])
        j = int(np.searchsorted(placed, low + SLICE, "left"))
        last = int(placed[j - 1])
        found[order[i:j]] = _hashes(data[low:last + width], width)[placed[i:j] - low].view(np.int64)
        i = j
    return found


class Chunk:
    """The texts of a chunk in one array, cut into runs of windows with the same anchor."""

    def __init__(self, docs: pa.Table, span: int, looks: bool = False):
        unpack = zstandard.ZstdDecompressor().decompress
        texts = [unpack(t) if t else t for t in docs["packed"].to_pylist()]
        ids = docs["doc_id"].to_pylist()
        # a shuffle delivers rows in any order, but strings must have the same number every time
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, texts[k] or b""))
        self.docs, self.texts, ids = docs.take(order), [texts[k] for k in order], [ids[k] for k in order]
        sizes = np.array([len(t or b"") for t in self.texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.data = np.frombuffer(b"".join(t or b"" for t in self.texts), np.uint8)
        self.span = span
        self.runs(looks)

    def runs(self, looks: bool) -> None:
        """Sets first window, number of windows, anchor and row of every run, and with ``looks`` its
        look: runs of equal bytes look alike."""
        first, count, anchor, row, look = [], [], [], [], []
        piece = min(PIECE, self.span)
        behind = self.span - piece
        usable = np.flatnonzero(self.known & (self.ends - self.starts >= self.span))
        total = len(self.data)
        if len(usable):
            open_, last = self.starts[usable], self.ends[usable] - self.span + 1
            for low in range(0, total, SLICE):
                high = min(low + SLICE, total - self.span + 1)
                if high <= low:
                    break
                h = _hashes(self.data[low:high + self.span - 1], piece)
                a = _lowest(h, behind + 1)
                edge = np.ones(len(a), bool)
                edge[1:] = a[1:] != a[:-1]
                # windows that lie in one document: add one where they begin, take it where they end
                i, j = np.searchsorted(last, low, "right"), np.searchsorted(open_, high, "left")
                step = np.zeros(high - low + 1, np.int8)
                step[np.maximum(open_[i:j], low) - low] += 1
                stop = np.minimum(last[i:j], high) - low
                edge[np.maximum(open_[i:j], low) - low] = True
                edge[stop[stop < high - low]] = True
                np.subtract.at(step, stop, 1)
                inside = np.cumsum(step[:-1], dtype=np.int8) > 0
                at = np.flatnonzero(edge)
                size = np.diff(np.append(at, high - low))
                at, size = at[inside[at]], size[inside[at]]
                first.append(at + low)
                count.append(size)
                anchor.append(a[at])
                row.append(usable[np.searchsorted(open_, at + low, "right") - 1])
                if looks:  # by its first piece, one in the middle, and its last one
                    mid, last_piece = h[at + (size - 1 + behind) // 2], h[at + size - 1 + behind]
                    look.append((h[at] * _MIX[1] + mid * _MIX[2] + last_piece * _MIX[4] + size.astype(np.uint64)).view(np.int64))
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        first, count, anchor, row, look = map(join, (first, count, anchor, row, look))
        # text that goes on repeating itself keeps its anchor: cut it, or its columns have no end
        cuts = -(-count // RUN)
        step = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        self.first = np.repeat(first, cuts) + RUN * step
        self.count = np.minimum(np.repeat(count, cuts) - RUN * step, RUN)
        self.anchor, self.row = np.repeat(anchor, cuts), np.repeat(row, cuts)
        if looks:
            self.look = np.repeat(look, cuts) + step

    def listed(self) -> np.ndarray:
        """Each anchor once; low byte 0: in one document, else how many different runs it has: k
        stands for 2 ** (k / ``STEPS``), rounded up."""
        order = np.argsort(self.anchor, kind="stable")
        a, d = self.anchor[order], self.ids[self.row[order]]
        if not len(a):
            return a
        begin = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        several = np.minimum.reduceat(d, begin) < np.maximum.reduceat(d, begin)
        runs = np.diff(np.append(begin, len(a)))
        # those with many runs: how many look different?
        many = np.flatnonzero(runs >= MANY)
        if len(many):
            group = np.repeat(np.arange(len(many)), runs[many])
            step = np.arange(len(group)) - np.repeat(np.cumsum(runs[many]) - runs[many], runs[many])
            looks = self.look[order[begin[many][group] + step]]
            by = np.lexsort((looks, group))
            group, looks = group[by], looks[by]
            new = np.append(True, (group[1:] != group[:-1]) | (looks[1:] != looks[:-1]))
            runs[many] = np.bincount(group[new], minlength=len(many))
        return a[begin] | np.where(several, np.maximum(np.ceil(STEPS * np.log2(runs)).astype(np.int64), 1), 0)

    def strings(self, shared: np.ndarray) -> dict[bytes, int]:
        """Numbers the different strings at shared anchors; sets which run has which string.

        ``shared`` is sorted; an odd entry is an anchor whose windows are cut singly.
        """
        base = shared & ~np.int64(255)
        where = np.searchsorted(base, self.anchor)
        found = np.zeros(len(self.anchor), bool)
        inner = where < len(base)
        found[inner] = base[where[inner]] == self.anchor[inner]
        use = np.flatnonzero(found)
        first, count, row, group = self.first[use], self.count[use], self.row[use], self.anchor[use]
        single = (shared[where[use]] & 1).astype(bool)
        if single.any():
            n = count[single]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            first = np.concatenate([first[~single], np.repeat(first[single], n) + step])
            row = np.concatenate([row[~single], np.repeat(row[single], n)])
            whole = count[~single]
            count = np.concatenate([whole, np.ones(n.sum(), np.int64)])
            cut = first[len(whole):]
            own = _hashes_at(self.data, cut, self.span)
            group = np.concatenate([group[~single], own & ~np.int64(255)])
        self.use_first, self.use_count, self.use_row, self.use_group = first, count, row, group
        all_bytes, extra, numbers = self.data.tobytes(), self.span - 1, {}
        put = numbers.setdefault
        self.use_string = np.fromiter(
            (put(all_bytes[p:p + n + extra], len(numbers))
             for p, n in zip(first.tolist(), count.tolist(), strict=True)), np.int64, len(first))
        return numbers


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of sorted keys, and where each begins, with the end."""
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys
    return keys[begin], np.append(begin, len(keys))


def _bucket(anchors: np.ndarray, buckets: int) -> np.ndarray:
    # the smallest of many hashes is small: mix it before dealing
    mixed = (anchors.view(np.uint64) >> np.uint64(8)) * _MIX[5]
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


ANCHORS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("anchors", pa.list_(pa.int64()))])
SHARED = pa.schema([("chunk", pa.int64()), ("anchors", pa.list_(pa.int64()))])
STRINGS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("number", pa.list_(pa.int32())),
                     ("size", pa.list_(pa.int32())), ("owner", pa.list_(pa.int64())),
                     ("further", pa.list_(pa.int64())),
                     ("body", pa.binary())])
OWNERS = pa.schema([("chunk", pa.int64()), ("number", pa.list_(pa.int32())),
                    ("windows", pa.list_(pa.int32())), ("owners", pa.list_(pa.int64()))])


@giving_back
def list_anchors(docs: pa.Table, span: int, buckets: int) -> pa.Table:
    """Step 2, a chunk's side: its anchors by bucket."""
    listed = Chunk(docs, span, looks=True).listed()
    bucket = _bucket(listed & ~np.int64(255), buckets)
    order = np.argsort(bucket, kind="stable")
    keys, bounds = _bounds(bucket[order])
    chunk = docs["chunk"][0].as_py()
    return pa.Table.from_arrays([pa.array(keys), pa.array(np.full(len(keys), chunk)),
                                 _lists(listed[order], bounds, pa.int64())], schema=ANCHORS)


@giving_back
def share_anchors(rows: pa.Table) -> pa.Table:
    """Step 2, a bucket's side: each chunk's anchors that several documents have."""
    values = rows["anchors"].combine_chunks()
    values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
    flat = values.flatten().to_numpy(zero_copy_only=False)
    chunk = np.repeat(rows["chunk"].to_numpy(), np.diff(values.offsets.to_numpy()))
    anchor, runs = flat & ~np.int64(255), flat & 255
    order = np.argsort(anchor, kind="stable")
    anchor, runs, chunk = anchor[order], runs[order], chunk[order]
    _, bounds = _bounds(anchor)
    if not len(anchor):
        return SHARED.empty_table()
    each = np.diff(bounds)
    shared = (each > 1) | (np.maximum.reduceat(runs, bounds[:-1]) > 0)
    hot = np.add.reduceat(2.0 ** (runs / STEPS), bounds[:-1]) > HOT
    keep = np.repeat(shared, each)
    out, chunk = (anchor | np.repeat(hot, each))[keep], chunk[keep]
    order = np.argsort(chunk, kind="stable")
    keys, bounds = _bounds(chunk[order])
    return pa.Table.from_arrays([pa.array(keys, pa.int64()), _lists(out[order], bounds, pa.int64())],
                                schema=SHARED)


def _joined(rows: pa.Table, name: str) -> np.ndarray:
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in rows[name].chunks]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


@giving_back
def cut_strings(docs: pa.Table, shared: pa.Table, span: int, buckets: int) -> pa.Table:
    """Step 3: a chunk's different strings at shared anchors, by bucket."""
    if not docs.num_rows or not shared.num_rows:
        return STRINGS.empty_table()
    chunk = Chunk(docs, span)
    numbers = chunk.strings(np.sort(_joined(shared, "anchors")))
    n = len(numbers)
    owner, last = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    ids = chunk.ids[chunk.use_row]
    np.minimum.at(owner, chunk.use_string, ids)
    np.maximum.at(last, chunk.use_string, ids)
    anchor = np.zeros(n, np.int64)
    anchor[chunk.use_string] = chunk.use_group
    bucket = _bucket(anchor, buckets)
    order = np.argsort(bucket, kind="stable")
    keys, bounds = _bounds(bucket[order])
    bodies = list(numbers)
    size = np.fromiter(map(len, bodies), np.int64, n)
    pack = zstandard.ZstdCompressor().compress
    joined = [pack(b"".join(bodies[k] for k in order[a:b].tolist()))
              for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.Table.from_arrays([
        pa.array(keys, pa.int64()), pa.array(np.full(len(keys), docs["chunk"][0].as_py()), pa.int64()),
        _lists(order, bounds, pa.int32()), _lists(size[order], bounds, pa.int32()),
        _lists(owner[order], bounds, pa.int64()),
        # mostly 0: one document of the chunk has the string
        _lists((last - owner)[order], bounds, pa.int64()), pa.array(joined, pa.binary())], schema=STRINGS)


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The smallest value of each range, by the smallest of every 1, 2, 4, ... values in a row."""
    power = np.frexp((end - begin).astype(np.float64))[1] - 1
    found, row = np.empty(len(begin), values.dtype), values
    for k in range(int(power.max()) + 1):
        here = np.flatnonzero(power == k)
        found[here] = np.minimum(row[begin[here]], row[end[here] - (1 << k)])
        row = np.minimum(row[:-(1 << k)], row[1 << k:])
    return found


def column_wise(strings: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and common prefixes of a collection, built one column per round.

    Returns the suffixes in order, as positions in the joined strings (a string's end counts as
    one position more), and the bytes each has in common with the one before, at most ``depth``.
    Ends are smaller than every byte and differ from each other.
    """
    m = len(strings)
    size = np.fromiter(map(len, strings), np.int64, m)
    symbols = np.frombuffer(b"".join(strings), np.uint8)
    # 0 is an end. UTF-8 has no byte 255, so that symbols fit one byte, which sorts faster
    kind = np.uint8 if not len(symbols) or symbols.max() < 255 else np.uint16
    symbols = symbols.astype(kind) + kind(1)
    start = np.cumsum(size) - size
    # round 0: the ends, with the last symbol of each string in the transform
    ends = start + size
    transform = np.where(size > 0, symbols[np.maximum(ends - 1, 0)], 0).astype(kind)
    common = np.zeros(m, np.uint8)
    suffix = (ends + np.arange(m)).astype(np.int32)  # a place for each end
    place, active = np.arange(m), np.arange(m)
    for done in range(1, int(size.max(initial=0)) + 1):
        stay = size[active] >= done
        active, place = active[stay], place[stay]
        total = len(transform)
        order = np.argsort(transform, kind="stable")
        rank = np.empty(total, np.int32)
        rank[order] = np.arange(total, dtype=np.int32)
        blank = int(np.count_nonzero(transform == 0))
        mine = rank[place].astype(np.int64)
        sorted_symbols = transform[order]
        # common prefixes of the new suffixes and of those that follow them
        fresh = np.zeros(total + 1, bool)
        fresh[mine] = True
        fresh[mine + 1] = True
        touched = np.flatnonzero(fresh[:total])
        touched = touched[touched > blank]
        touched = touched[sorted_symbols[touched] == sorted_symbols[touched - 1]]
        value = np.zeros(total, np.uint8)
        if len(touched):
            least = _least(common, order[touched - 1] + 1, order[touched] + 1)
            value[touched] = np.minimum(least, depth - 1) + 1
        # the new suffixes go between the old ones
        size_now = m + total - blank
        is_new = np.zeros(size_now, bool)
        new_place = m + mine - blank
        is_new[new_place] = True
        is_old = ~is_new
        grown = np.empty(size_now, np.uint8)
        grown[is_old] = common
        changed = np.flatnonzero(fresh[blank:total])
        grown[m + changed] = value[blank + changed]
        new_transform = np.empty(size_now, kind)
        new_transform[is_old] = transform
        at = start[active] + size[active] - done
        left = np.where(size[active] > done, symbols[np.maximum(at - 1, 0)], 0)
        new_transform[new_place] = left
        new_suffix = np.empty(size_now, np.int32)
        new_suffix[is_old] = suffix
        new_suffix[new_place] = at + active
        transform, common, suffix, place = new_transform, grown, new_suffix, new_place
    return suffix, common


def _owners_of(strings: list[bytes], owner: np.ndarray, span: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each string the owner of each of its windows, and the smallest of them."""
    suffix, common = column_wise(strings, span)
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    start = np.cumsum(size) - size + np.arange(len(strings))
    string = np.searchsorted(start, suffix, "right") - 1
    begin = np.flatnonzero(common < span)
    least = np.minimum.reduceat(owner[string], begin)
    per = np.repeat(least, np.diff(np.append(begin, len(suffix))))
    flat = np.empty(int(size.sum()) + len(strings), np.int64)
    flat[suffix] = per
    ends = start + size - span + 1
    least = np.minimum.reduceat(flat, np.stack([start, ends], 1).ravel())[::2]
    return [flat[a:b] for a, b in zip(start.tolist(), ends.tolist(), strict=True)], least


@giving_back
def sort_strings(rows: pa.Table, span: int) -> pa.Table:
    """Step 4: the owners of the windows of all strings of a bucket, for each chunk."""
    size, owner, further, number = (_joined(rows, n) for n in ("size", "owner", "further", "number"))
    last = owner + further
    each = np.concatenate([np.diff(c.offsets.to_numpy()) for c in rows["number"].chunks])
    chunk = np.repeat(rows["chunk"].to_numpy(), each)
    body = b"".join(map(zstandard.ZstdDecompressor().decompress, rows["body"].to_pylist()))
    ends = np.cumsum(size)
    numbers: dict[bytes, int] = {}
    put = numbers.setdefault
    which = np.fromiter((put(body[e - n:e], len(numbers))
                         for e, n in zip(ends.tolist(), size.tolist(), strict=True)), np.int64, len(size))
    strings = list(numbers)
    least = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(least, which, owner)
    # strings that share a window have the same anchor in every window of theirs, so in the first
    group = np.zeros(len(strings), np.int64)
    group[which] = _anchors_at(body, ends - size, span)
    order = np.argsort(group, kind="stable")
    _, bounds = _bounds(group[order])
    owners: list[np.ndarray | None] = [None] * len(strings)
    waiting: list[int] = []
    bound = least.copy()

    def settle() -> None:
        found, bound[waiting] = _owners_of([strings[k] for k in waiting], least[np.array(waiting)], span)
        for k, o in zip(waiting, found, strict=True):
            owners[k] = o
        waiting.clear()

    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:  # a string alone in its group has only its own owner
            waiting.extend(order[a:b].tolist())
            if len(waiting) >= SORTED_AT_ONCE:
                settle()
    if waiting:
        settle()
    # a chunk hears of a string only if one of its documents loses something by it
    tell = np.flatnonzero(bound[which] < last)
    tell = tell[np.argsort(chunk[tell], kind="stable")]
    keys, bounds = _bounds(chunk[tell])
    told = which[tell].tolist()
    windows = size[tell] - span + 1
    flat = np.repeat(least[which[tell]], windows)
    for k, a, n in zip(told, (np.cumsum(windows) - windows).tolist(), windows.tolist(), strict=True):
        if owners[k] is not None:
            flat[a:a + n] = owners[k]
    # equal neighbours once, with their number
    edge = np.ones(len(flat), bool)
    edge[1:] = flat[1:] != flat[:-1]
    edge[np.cumsum(windows)[:-1]] = True
    at = np.flatnonzero(edge)
    length = np.diff(np.append(at, len(flat)))
    cuts = np.searchsorted(at, np.append(0, np.cumsum(windows))[bounds])
    return pa.Table.from_arrays([
        pa.array(keys, pa.int64()), _lists(number[tell], bounds, pa.int32()),
        _lists(length, cuts, pa.int32()), _lists(flat[at], cuts, pa.int64())], schema=OWNERS)


def _nullable(kind: pa.DataType) -> pa.DataType:
    """A type whose inner fields may be null, as the declared result has them."""
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, _nullable(f.type)) for f in kind])
    return pa.list_(_nullable(kind.value_type)) if pa.types.is_list(kind) else kind


def _spans(docs: pa.Table, told: pa.Table, span: int) -> tuple[Chunk, np.ndarray]:
    """Step 5: which bytes of a chunk go."""
    chunk = Chunk(docs, span)
    gone = np.zeros(len(chunk.data) + 1, np.int32)
    shared = told.filter(pc.is_valid(told["anchors"]))
    owned = told.filter(pc.is_valid(told["number"]))
    if owned.num_rows:
        chunk.strings(np.sort(_joined(shared, "anchors")))
        numbers = _joined(owned, "number").astype(np.int64)
        flat = np.repeat(_joined(owned, "owners"), _joined(owned, "windows"))
        windows = np.zeros(int(chunk.use_string.max(initial=-1)) + 1, np.int64)
        windows[chunk.use_string] = chunk.use_count
        n = windows[numbers]
        offset = np.full(len(windows), -1)
        offset[numbers] = np.cumsum(n) - n
        hit = np.flatnonzero(offset[chunk.use_string] >= 0)
        count = chunk.use_count[hit]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        owner = flat[np.repeat(offset[chunk.use_string[hit]], count) + step]
        begin = np.repeat(chunk.use_first[hit], count) + step
        begin = begin[owner < np.repeat(chunk.ids[chunk.use_row[hit]], count)]
        np.add.at(gone, begin, 1)
        np.subtract.at(gone, begin + span, 1)
    return chunk, np.cumsum(gone[:-1]) > 0


@giving_back
def remove_spans(docs: pa.Table, told: pa.Table, span: int) -> pa.Table:
    """Step 5: each document with the bytes it keeps and the spans it loses."""
    chunk, gone = _spans(docs, told, span)
    kept, starts, ends = [], [], []
    for a, b, text in zip(chunk.starts.tolist(), chunk.ends.tolist(), chunk.texts, strict=True):
        mask = gone[a:b]
        if not mask.any():
            kept.append(text)
            starts.append([])
            ends.append([])
            continue
        change = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]])))
        starts.append(change[0::2].tolist())
        ends.append(change[1::2].tolist())
        kept.append(chunk.data[a:b][~mask].tobytes())
    return pa.Table.from_arrays([
        chunk.docs["doc_id"], chunk.docs["rest"].cast(_nullable(docs["rest"].type)), pa.array(chunk.ends - chunk.starts, pa.int64()),
        pa.array(kept, pa.binary()), pa.array(starts, pa.list_(pa.int64())),
        pa.array(ends, pa.list_(pa.int64()))],
        names=["doc_id", "rest", "n_bytes", "kept", "span_starts", "span_ends"])


def _spark_schema(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.list_(pa.int64()): "array<long>", pa.list_(pa.int32()): "array<int>",
             pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _chunk_bytes(size: int) -> int:
    """Text of a chunk: the geometric mean of all text and 4 KB, within bounds."""
    return int(min(max(CHUNK_BYTES, (size * 4096) ** 0.5), LARGEST_CHUNK))


def repeated_spans(docs: DataFrame, span: int = SPAN, chunk_bytes: int | None = None) -> DataFrame:
    """For each row of ``docs`` the byte spans that a document with a smaller id holds already.

    Takes ``doc_id`` (integer) and ``text``. Every byte covered by a string of ``span`` bytes that
    also starts in a document with a smaller id is removed; strings are judged on the input, so
    overlapping ones all count, and matches never cross documents. Returns ``doc_id``, all other
    input columns as the struct ``rest``, ``n_bytes``, ``kept`` (the remaining bytes) and the removed
    spans as ``span_starts`` and ``span_ends`` (the end is outside).

    A null text has no bytes, and null is kept of it. A null id is in no order with others: such a row neither loses
    bytes nor makes others lose them. Rows with the same id don't take from each other; rows equal in
    id and text lie in one chunk. A text longer than a chunk is a chunk of its own, hashed in slices. An
    empty table gives an empty table. Further columns are carried in ``rest``.

    Each chunk sends a list of its anchors to each group of anchors that it has some of, and there are
    as many groups as chunks. So there are never more lists than anchors, which are in proportion to the
    text. Lists stay long because chunks grow with the square root of the text, from 4 MB to 256 MB
    (``chunk_bytes`` sets another size); a task holds about eight times as much.
    """
    table = take(docs, "doc_id", "text", rest="rest", without="text")
    size = take(docs, "text").agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    chunks = max(1, -(-size // (chunk_bytes or _chunk_bytes(size))))
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chunks // 16))
    table = (table.select(F.col("doc_id").cast("long"), compressed("text").alias("packed"), "rest",
                          F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"))
             .repartition(parts, "chunk"))
    anchors = (table.groupBy("chunk")
               .applyInArrow(lambda t: list_anchors(t, span, chunks), _spark_schema(ANCHORS)))
    shared = anchors.groupBy("bucket").applyInArrow(lambda t: share_anchors(t), _spark_schema(SHARED))
    strings = (table.groupBy("chunk").cogroup(shared.groupBy("chunk"))
               .applyInArrow(lambda a, b: cut_strings(a, b, span, chunks), _spark_schema(STRINGS)))
    owners = strings.groupBy("bucket").applyInArrow(lambda t: sort_strings(t, span),
                                                    _spark_schema(OWNERS))
    told = shared.unionByName(owners, allowMissingColumns=True)
    kind = table.schema["rest"].dataType.simpleString()
    return (table.groupBy("chunk").cogroup(told.groupBy("chunk"))
            .applyInArrow(lambda a, b: remove_spans(a, b, span) if a.num_rows else _nothing(a),
                          f"doc_id long, rest {kind}, n_bytes long, kept binary,"
                          " span_starts array<long>, span_ends array<long>"))


def _nothing(docs: pa.Table) -> pa.Table:
    return pa.table({"doc_id": docs["doc_id"], "rest": docs["rest"].cast(_nullable(docs["rest"].type)),
                     "n_bytes": pa.array([], pa.int64()), "kept": pa.array([], pa.binary()),
                     "span_starts": pa.array([], pa.list_(pa.int64())),
                     "span_ends": pa.array([], pa.list_(pa.int64()))})


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """The rows of ``docs`` with ``repeated_spans`` cut out of ``text``, all columns kept.

    ``n_chars`` is set to the new length. A character that loses some of its bytes goes whole. A
    document that keeps nothing stays, with an empty text; a null text stays null.
    """
    found = repeated_spans(docs, span)
    cut = F.size("span_starts") > 0
    at = docs.columns.index
    text = whole_characters("kept")
    changed = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = (F.when(cut, F.length(text).cast(kind))
                              .otherwise(F.col(f"rest.c{at('n_chars')}")))
    return found.select(*spread("rest", docs.columns, **changed))


@F.arrow_udf(StringType())
def whole_characters(data: pa.Array) -> pa.Array:
    """Bytes as text, without broken characters."""
    texts = pa.array([None if b is None else b.decode("utf-8", "ignore") for b in in_bytes(data)], pa.string())
    give_back()
    return texts

