"""Terms of a text as numbers: where each begins and ends, and a hash of its letters.

A term is a longest run of digits, a-z and characters beyond ASCII, once A-Z are lower-cased. So
it begins and ends at bytes, and whole batches of texts are cut at once, joined by a byte that is
no letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from .words import _powers, mixed

#: Bytes whose terms are cut at once; arrays of a few times as many 64-bit numbers are held.
SLICE = 1 << 18
#: Texts are joined up to so many bytes.
JOINED = 1 << 20
#: A longer term is hashed by itself.
LONG = 256


def _letters() -> np.ndarray:
    table = np.zeros(256, bool)
    table[ord("0"):ord("9") + 1] = table[ord("a"):ord("z") + 1] = table[0x80:] = True
    return table


LETTER = _letters()


def _cut(whole: np.ndarray, low: int) -> int:
    """Where a slice from ``low`` on ends: behind a byte that is no letter, or with the text."""
    high = low + SLICE
    if high >= len(whole):
        return len(whole)
    gaps = np.flatnonzero(~LETTER[whole[low:high]])
    while not len(gaps) and high < len(whole):  # one term longer than a slice
        low, high = high, high + SLICE
        gaps = np.flatnonzero(~LETTER[whole[low:high]])
        if len(gaps):
            return low + int(gaps[0]) + 1
    return low + int(gaps[-1]) + 1 if len(gaps) else len(whole)


def terms(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of every term of a text in UTF-8 whose A-Z are lower-cased already."""
    whole = np.frombuffer(text, np.uint8)
    begins, ends, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    low = 0
    while low < len(whole):
        high = _cut(whole, low)
        data = whole[low:high]
        edge = np.diff(np.concatenate([[False], LETTER[data], [False]]).astype(np.int8))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(begin):
            size = end - begin
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(first, size)
            letters = place + np.repeat(begin, size)
            longest = int(size.max())
            if longest > LONG:
                place = np.minimum(place, LONG - 1)
            values = (data[letters].astype(np.uint64) + np.uint64(1)) * _powers(min(longest, LONG))[place]
            h = mixed(np.add.reduceat(values, first) + size.astype(np.uint64))
            for k in np.flatnonzero(size > LONG).tolist():
                h[k] = xxhash.xxh64_intdigest(data[begin[k]:end[k]].tobytes())
            begins.append(begin + low)
            ends.append(end + low)
            hashes.append(h)
        low = high
    return np.concatenate(begins), np.concatenate(ends), np.concatenate(hashes)


def joined(texts: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """The texts of a column (null: empty) in groups of neighbours: the number of the first, all of
    them lower-cased and joined by a NUL, and where each begins (and one more place, behind the end)."""
    group: list[bytes] = []
    first, size = 0, 0
    for k, text in enumerate(texts.cast(pa.large_binary())):
        text = text.as_py() or b""
        if group and size + len(text) > JOINED:
            yield first, *_group(group)
            group, first, size = [], k, 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield first, *_group(group)


def _group(group: list[bytes]) -> tuple[bytes, np.ndarray]:
    sizes = np.fromiter(map(len, group), np.int64, len(group)) + 1
    return b"\0".join(group).lower(), np.append(0, np.cumsum(sizes))
