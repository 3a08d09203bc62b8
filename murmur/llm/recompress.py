"""Recompression of word sequences: rounds that name runs and pairs.

A round first names maximal runs of one symbol, then assigns every symbol to a left or right side by
its name and names each pair of a left symbol followed by a right one. A name is a hash of the words
that the symbol stands for, so equal symbols get equal names wherever they are, in any task, and no
round needs a table of names. Beside its words a symbol has a context: the range of words around it
that made it what it is. Wherever that range of words occurs, the symbol occurs at the same place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from murmur.llm._words import RangeHash, mix


@dataclass
class Level:
    """Symbols over words [start, end) with context [low, high)."""

    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _joined(first: np.ndarray, x: np.ndarray, how) -> np.ndarray:
    return how.reduceat(x, first) if len(first) else x[:0]


def rounds(words: np.ndarray, doc: np.ndarray, first: np.ndarray, ranges: RangeHash, levels: int):
    """Yields the levels 1, 2, ... of flat word hashes; ``doc`` is the document of each word, and
    document d has the words [first[d], first[d + 1])."""
    n = len(words)
    at = np.arange(n)
    level = Level(at, at + 1, at, at + 1)
    far = np.int64(1) << 40  # a context that leaves the document can be in no window
    for number in range(levels):
        s, e, lo, hi = level.start, level.end, level.low, level.high
        m = len(s)
        if not m:
            yield level
            continue
        d = doc[s]
        opens = np.concatenate([[True], d[1:] != d[:-1]])  # first symbol of its document
        closes = np.concatenate([opens[1:], [True]])
        # runs
        name = ranges.of(s, e)
        begins = opens.copy()
        begins[1:] |= name[1:] != name[:-1]
        at = np.flatnonzero(begins)
        s, e = s[at], e[np.concatenate([at[1:], [m]]) - 1]
        lo, hi, low_, high_ = _joined(at, lo, np.minimum), _joined(at, hi, np.maximum), lo, hi
        opens, closes = opens[at], closes[np.concatenate([at[1:], [m]]) - 1]
        # it ends because its neighbours differ: their nearest word may show that, else all their context does
        left = np.where(opens, -far, 0)
        i = np.flatnonzero(~opens)
        plain = words[s[i] - 1] != words[e[i] - 1]
        left[i] = np.where(plain, s[i] - 1, low_[at[i] - 1])
        right = np.where(closes, far, 0)
        j = np.flatnonzero(~closes)
        plain = words[e[j]] != words[s[j]]
        right[j] = np.where(plain, e[j] + 1, high_[at[j + 1]])
        lo, hi = np.minimum(lo, left), np.maximum(hi, right)
        # pairs
        name = mix(ranges.of(s, e) + np.uint64((2 * number + 1) * 0x9E3779B97F4A7C15 % 2**64))
        is_left = (name & np.uint64(1)).astype(bool)
        m = len(s)
        pair = np.zeros(m, bool)  # with the one before
        pair[1:] = ~opens[1:] & is_left[:-1] & ~is_left[1:]
        paired = pair.copy()
        paired[:-1] |= pair[1:]
        # an unpaired left symbol saw a left one after it, an unpaired right one a right one before it
        lo2, hi2 = lo.copy(), hi.copy()
        i = np.flatnonzero(~paired & is_left & ~closes)
        lo2[i], hi2[i] = np.minimum(lo[i], lo[i + 1]), np.maximum(hi[i], hi[i + 1])
        i = np.flatnonzero(~paired & ~is_left & ~opens)
        lo2[i], hi2[i] = np.minimum(lo[i], lo[i - 1]), np.maximum(hi[i], hi[i - 1])
        lo2[~paired & ~is_left & opens] = -far
        hi2[~paired & is_left & closes] = far
        at = np.flatnonzero(~pair)
        level = Level(s[at], e[np.concatenate([at[1:], [m]]) - 1], _joined(at, lo2, np.minimum), _joined(at, hi2, np.maximum))
        yield level
