"""Words of whole texts as flat numpy arrays, shared by the Arrow-batch operators.

A word is a maximal run of bytes outside blank, tab, LF, VT, FF and CR. Texts are read straight
from the Arrow buffers of a batch, a few megabytes at a time (a single longer text is one piece).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
PIECE_BYTES = 1 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 256

_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    h = h ^ (h >> _S33)
    h *= _M1
    h ^= h >> _S33
    h *= _M2
    h ^= h >> _S33
    return h


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a string column; a null is an empty text."""
    column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "")
    if pa.types.is_string(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.large_string()), np.int64
    _, off, data = column.buffers()
    n = len(column)
    if n == 0 or off is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(off, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, offsets from 0, bytes) of runs of whole texts."""
    offsets, data = text_buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, offsets[lo:hi + 1] - offsets[lo], data[offsets[lo]:offsets[hi]]
        lo = hi


@dataclass
class Words:
    starts: np.ndarray  # byte positions
    ends: np.ndarray
    first: np.ndarray  # of each text, the index of its first word; one more entry than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def find_words(offsets: np.ndarray, data: np.ndarray, blank: np.ndarray = BLANK) -> Words:
    n = len(data)
    solid = np.zeros(n + 2, np.int8)
    solid[1:-1] = ~blank[data]
    edge = np.diff(solid)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = np.unique(offsets)
    cuts = cuts[(cuts > 0) & (cuts < n)]
    cuts = cuts[(solid[cuts] == 1) & (solid[cuts + 1] == 1)]  # a text ends and the next begins inside a run
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return Words(starts, ends, np.searchsorted(starts, offsets, side="left"))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes at a time over all words."""
    buf = np.zeros(len(data) + 8, np.uint8)
    buf[:len(data)] = data
    lanes = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=buf, strides=(1,))
    length = ends - starts
    h = mix(lanes[starts] & _MASK[np.minimum(length, 8)] ^ (length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    more, at = np.flatnonzero(length > 8), 8
    if len(more):
        for i in np.flatnonzero(length > LONG_WORD):
            h[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
        more = more[length[more] <= LONG_WORD]
    while len(more):
        left = length[more] - at
        h[more] = mix(h[more] * np.uint64(0x9FB21C651E98DF25) ^ (lanes[starts[more] + at] & _MASK[np.minimum(left, 8)]))
        at += 8
        more = more[left > 8]
    return h


class RangeHash:
    """Hash of any range of a sequence from prefix sums modulo 2**64:
    (sum of h[k] * base**k over [i, j)) * base**-i."""

    def __init__(self, h: np.ndarray, base: int = 0xD1342543DE82EF95):
        inverse = pow(base, -1, 1 << 64)
        up, self.down = _powers(base, len(h)), _powers(inverse, len(h) + 1)
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[:len(h)], out=self.sums[1:])

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return (self.sums[j] - self.sums[i]) * self.down[i]


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << max(12, int(n).bit_length()), base & (2**64 - 1), np.uint64)
        have[0] = 1
        have = np.cumprod(have)
        if len(have) <= 1 << 21:
            _POWERS[base] = have
    return have


def code_points(data: np.ndarray) -> np.ndarray:
    """Prefix counts: how many characters begin before each byte position."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
