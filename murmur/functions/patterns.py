"""Long lists of words in whole texts: a multi-pattern automaton for lists of a bounded size, a window
index for lists of any size. Both work on the UTF-8 bytes of Arrow batches; a word is part of a text
if and only if its bytes are part of the text's bytes."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a word list that an automaton takes (some 4 x 40 bytes of table for each).
AUTOMATON_BYTES = 1 << 18
#: Stretch of a text that is followed byte by byte, side by side with the others.
STRETCH = 512
PIECE_BYTES = 1 << 20
#: Bits of the filter that tells which windows can be words.
FILTER_BITS = 24
#: Bytes of texts whose windows a task holds at a time, and of the Arrow batches that it gets.
WINDOW_BYTES, BATCH_BYTES = 1 << 18, 8 << 20

_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_M1, _M2, _S = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(31)


def text_bytes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, offsets from 0, bytes) of runs of whole texts; a null is empty."""
    column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "").cast(pa.large_string())
    _, off, raw = column.buffers()
    n = len(column)
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE_BYTES, side="right")) - 1)
        yield lo, hi, offsets[lo:hi + 1] - offsets[lo], data[offsets[lo]:offsets[hi]]
        lo = hi


class Automaton:
    """The words' trie with failure links folded into one flat table: next state by state and class of
    byte (bytes that no word holds are one class). States are numbered so that those at which a word
    ends, its own or a suffix, are the last ones."""

    def __init__(self, words: list[bytes]):
        words = sorted({w for w in words if w})
        self.longest = max(map(len, words), default=0)
        self.byte_class = np.zeros(256, np.int32)
        used = sorted(set(b"".join(words)))
        self.byte_class[used] = np.arange(1, len(used) + 1)
        self.classes = len(used) + 1
        children: list[dict[int, int]] = [{}]
        ends = [False]
        for w in words:
            at = 0
            for b in w:
                to = children[at].get(b)
                if to is None:
                    to = children[at][b] = len(children)
                    children.append({})
                    ends.append(False)
                at = to
            ends[at] = True
        table, fail = np.zeros((len(children), self.classes), np.int32), [0] * len(children)
        queue = deque([0])
        while queue:
            at = queue.popleft()
            row = table[fail[at]].copy() if at else np.zeros(self.classes, np.int32)
            for b, to in children[at].items():
                fail[to] = int(row[self.byte_class[b]])
                ends[to] = ends[to] or ends[fail[to]]
                row[self.byte_class[b]] = to
                queue.append(to)
            table[at] = row
        order = np.argsort(np.array(ends), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        self.table = (place[table[order]] * self.classes).ravel()  # next states as places of their rows
        self.first_end = int(np.sum(~np.array(ends))) * self.classes
        self.root = int(place[0]) * self.classes

    def found(self, column: pa.Array) -> np.ndarray:
        """Whether each text holds a word."""
        out = np.zeros(len(column), bool)
        for lo, hi, offsets, data in text_bytes(column):
            out[lo:hi] = self._found(offsets, self.byte_class[data])
        return out

    def _found(self, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
        # stretches overlap by the longest word less a byte, so that a word across two is in the second
        step = max(STRETCH, 4 * self.longest)
        size = np.diff(offsets)
        parts = -(-size // step)
        doc = np.repeat(np.arange(len(size)), parts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = offsets[doc] + np.maximum(nth * step - max(self.longest - 1, 0), 0)
        length = np.minimum(offsets[doc] + (nth + 1) * step, offsets[doc + 1]) - begin
        order = np.argsort(-length, kind="stable")
        begin, length, doc = begin[order], length[order], doc[order]
        state, hit = np.full(len(begin), self.root, np.int32), np.zeros(len(begin), bool)
        running = np.searchsorted(-length, -np.arange(1, int(length.max(initial=0)) + 1), side="right")
        for k, n in enumerate(running.tolist()):
            state[:n] = self.table[state[:n] + classes[begin[:n] + k]]
            hit[:n] |= state[:n] >= self.first_end
        out = np.zeros(len(size), bool)
        out[doc[hit]] = True
        return out


def holds_any(text: Column, words: list[str], spark) -> Column:
    """Whether ``text`` holds any of ``words``: the automaton is sent once to each executor and reads each
    text once, whatever the number of words. A null text holds none."""
    sent = spark.sparkContext.broadcast(Automaton([w.encode() for w in words]))

    @F.arrow_udf("boolean")
    def found(column: pa.Array) -> pa.Array:
        return pa.array(sent.value.found(column))

    return found(text)


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number (little-endian), zeros after the end."""
    buf = np.zeros(len(data) + 8, np.uint8)
    buf[:len(data)] = data
    return np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=buf, strides=(1,))


def _keys(lanes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key of the ``size`` bytes from each place."""
    key = np.full(len(at), size, np.uint64)
    for k in range(0, size, 8):
        key = (key ^ (lanes[at + k] & _MASK[min(8, size - k)])) * _M1
        key ^= key >> _S
        key *= _M2
        key ^= key >> _S
    return key


def _word_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, _, offsets, data in text_bytes(b.column(0)):
            size = np.diff(offsets)
            lanes = _lanes(data)
            bits = [_keys(lanes, offsets[:-1][size == n], int(n)) >> np.uint64(64 - FILTER_BITS) for n in np.unique(size)]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(bits)).astype(np.int64))], names=["bit"])


def window_filter(words: DataFrame) -> tuple[list[int], np.ndarray]:
    """The words' lengths in bytes, and a bitmap (2 ** FILTER_BITS bits, whatever the number of words) of
    their keys: what tasks need to pass on only windows that can be words. ``words``: one column."""
    lengths = sorted(r[0] for r in words.select(F.octet_length(words.columns[0])).distinct().collect())
    bits = words.mapInArrow(_word_bits, "bit bigint").select((F.shiftright("bit", 6)).alias("at"), F.expr("shiftleft(1L, cast(bit & 63 AS int))").alias("bits"))
    found = bits.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return lengths, out


def _firsts(row: np.ndarray, at: np.ndarray, lanes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the windows that begin at ``at``, each once in a row."""
    key = _keys(lanes, at, size)
    order = np.lexsort((key, row))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (row[order][1:] != row[order][:-1])
    return row[order[new]], at[order[new]]


def _distinct(row: np.ndarray, at: np.ndarray, lanes: np.ndarray, data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bytes) of the windows that begin at ``at``, each once in a row."""
    if size <= 5:  # row and bytes are one number
        shift = np.uint64(8 * size)
        both = np.unique((row.astype(np.uint64) << shift) | (lanes[at] & _MASK[size]))
        return (both >> shift).astype(np.int64), both.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
    row, at = _firsts(row, at, lanes, size)
    return row, np.lib.stride_tricks.sliding_window_view(data, size)[at] if len(at) else np.zeros((0, size), np.uint8)


def _possible(starts: np.ndarray, ends: np.ndarray, row: np.ndarray, data: np.ndarray, lanes: np.ndarray, size: int, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bytes) of the distinct windows of each row that the bitmap lets through. Its texts are
    data[starts:ends]; a stretch of places at a time."""
    upto = np.cumsum(np.maximum(ends - starts - size + 1, 0))
    total = int(upto[-1]) if len(upto) else 0
    shift = starts - np.concatenate([[0], upto[:-1]])
    rows, places = [], []
    for first in range(0, total, WINDOW_BYTES):
        place = np.arange(first, min(first + WINDOW_BYTES, total))
        of = np.searchsorted(upto, place, side="right")
        place += shift[of]
        bit = _keys(lanes, place, size) >> np.uint64(64 - FILTER_BITS)
        can = np.flatnonzero(mask[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1))
        rows.append(row[of[can]])
        places.append(place[can])
        if len(rows) > 16:  # of a long text, only the distinct ones are kept
            rows, places = ([x] for x in _firsts(np.concatenate(rows), np.concatenate(places), lanes, size))
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, size), np.uint8)
    return _distinct(np.concatenate(rows), np.concatenate(places), lanes, data, size)


def _row_slices(columns: list[pa.Array]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, starts, ends, rows from it, bytes) of the texts of runs of whole rows with about
    ``WINDOW_BYTES`` of text, all columns end to end; a null is empty."""
    parts = []
    for c in columns:
        c = pc.fill_null(c, "").cast(pa.large_string())
        _, off, raw = c.buffers()
        parts.append((np.frombuffer(off, np.int64)[c.offset:c.offset + len(c) + 1], np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)))
    n, lo = len(columns[0]), 0
    upto = sum(off for off, _ in parts) if n else np.zeros(1, np.int64)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + WINDOW_BYTES, side="right")) - 1)
        base = np.cumsum([0, *(int(off[hi] - off[lo]) for off, _ in parts)])
        offsets = [off[lo:hi + 1] - off[lo] + z for (off, _), z in zip(parts, base)]
        yield (lo, np.concatenate([o[:-1] for o in offsets]), np.concatenate([o[1:] for o in offsets]),
               np.tile(np.arange(hi - lo), len(parts)), np.concatenate([data[off[lo]:off[hi]] for off, data in parts]))
        lo = hi


def _told(sent, lengths: list[int], n_texts: int, names: list[str]):
    """mapInArrow body: rows of ``n_texts`` texts and columns to keep -> (kept columns, window)."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = sent.value
        for b in it:
            for lo, starts, ends, of, data in _row_slices(b.columns[:n_texts]):
                lanes, row, window = _lanes(data), [], []
                for size in lengths:
                    r, w = _possible(starts, ends, of, data, lanes, size, mask)
                    offsets = np.arange(len(r) + 1, dtype=np.int64) * size
                    row.append(r + lo)
                    window.append(pa.Array.from_buffers(pa.large_binary(), len(r), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(w))]))
                if sum(map(len, row)):
                    at = pa.array(np.concatenate(row))
                    yield pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns[n_texts:]), pa.concat_arrays(window).cast(pa.binary())], names=names)
    return batches


def words_in(rows: DataFrame, texts: list[Column], words: DataFrame, keep: list[str], total: str | None = None) -> DataFrame:
    """(``keep`` columns, word) for each row of ``rows`` and each of ``words`` (one column of any size, null
    or empty ones are skipped) that any of its ``texts`` holds: an equi-join on the texts' windows of
    the words' lengths. A row's windows are filtered and made distinct before they leave the task, which
    holds those of ``WINDOW_BYTES`` of texts (or of one longer row) at a time. ``total``: the number of
    rows, in a column of this name, for each (``keep``, word); windows are then counted before they are joined."""
    name = words.columns[0]
    words = words.where(F.octet_length(name) > 0).distinct()
    lengths, bits = window_filter(words)
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(bits)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    told = rows.select(*[t.alias(f"_t{k}") for k, t in enumerate(texts)], *keep).mapInArrow(_told(sent, lengths, len(texts), [*keep, name]), f"{fields}, `{name}` binary")
    if total:
        told = told.groupBy(*keep, name).agg(F.count(F.lit(1)).alias(total))
    found = told.join(words.select(F.col(name).cast("binary").alias(name)), name)
    return found.select(*keep, F.col(name).cast("string").alias(name), *[total] * bool(total))
