"""Numpy steps over many texts at once: words, word hashes, hashes of word windows.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r; in UTF-8 none of these bytes is part of a
longer character, so byte work gives the same words as work on code points.
All hashes are 64 bits wide and wrap around; `hash2` gives a second, independent one where 128 bits are wanted.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Odd multipliers of the two rolling hashes and their inverses modulo 2^64.
BASE = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
INVERSE = tuple(pow(b, -1, 1 << 64) for b in BASE)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Powers of a base that a worker keeps; those of a longer text are made for it alone.
KEPT_POWERS = (1 << 18) + 1024
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, KEPT_POWERS)
        have = np.full(size, base, U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size == KEPT_POWERS:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all others."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def word_bounds(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the row it is in."""
    if not len(buf):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    inside = ~SEPARATOR[buf]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    first = offs[:-1]
    before[first[first < len(buf)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    last = offs[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A hash of buf[s:e] for each span."""
    if not len(starts):
        return np.empty(0, U)
    sums = np.zeros(len(buf) + 1, U)
    np.cumsum((buf.astype(U) + U(1)) * powers(BASE[which], len(buf)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(INVERSE[which], len(buf))[starts]
    return mix(h + (ends - starts).astype(U) * U(0x2545F4914F6CDD1D))


def window_hash(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A hash of each run of `size` successive word hashes, over row borders too; the caller drops those."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, U)
    source = mix(words ^ U(0xA0761D6478BD642F)) if which else words
    sums = np.zeros(len(words) + 1, U)
    np.cumsum(source * powers(BASE[which], len(words)), out=sums[1:])
    return mix((sums[size:] - sums[:n]) * powers(INVERSE[which], n))


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words lie in a window of `size` words that starts at one of `starts`."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:n]) > 0


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Position of the smallest value (leftmost on ties) in each window of `size` values."""
    n = len(values)
    pos = np.arange(n)
    best = values.copy()
    done = 1
    while done < size:  # windows double until they have the wanted width
        step = min(done, size - done)
        left, right = best[: len(best) - step], best[step:]
        swap = right < left
        pos = np.where(swap, pos[step:], pos[: len(pos) - step])
        best = np.where(swap, right, left)
        done += step
    return pos
