"""Vectorised hashes of words and word runs of a text, for operators that count or sample them."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads hashes evenly over 64 bits (the finalizer of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _blank_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[32, *range(9, 14)]] = True
    return table


_BLANK = _blank_table()
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    """The first n powers of an odd number, modulo 2**64."""
    global _POWERS
    while len(_POWERS) < n:
        more = np.empty(max(n, 2 * len(_POWERS), 1024), np.uint64)
        more[0] = 1
        more[1:] = _ODD
        _POWERS = np.multiply.accumulate(more)
    return _POWERS[:n]


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of every word (between ASCII blanks) of a text; equal words have equal hashes.

    A word's hash is the sum of its bytes times powers of an odd number, taken from sums over the
    whole text: no step looks at single words.
    """
    data = np.frombuffer(text, np.uint8)
    inside = ~_BLANK[data]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return np.zeros(0, np.uint64)
    size = end - begin
    # place of each byte in its word
    owner = np.repeat(np.arange(len(begin)), size)
    letters = np.flatnonzero(inside)
    place = letters - begin[owner]
    values = (data[letters].astype(np.uint64) + np.uint64(1)) * _powers(int(size.max()))[place]
    first = np.cumsum(size) - size
    return mixed(np.add.reduceat(values, first) + size.astype(np.uint64))


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words; fewer words give one hash of them all."""
    if not len(words):
        return words
    width = min(width, len(words))
    h = words[:len(words) - width + 1].copy()
    for k in range(1, width):
        h = h * _STEP + words[k:len(words) - width + 1 + k]
    return mixed(h + np.uint64(width))
