"""Periodic runs of words by string synchronising sets.

A run is a maximal stretch of words with smallest period q, at least max(MIN_LENGTH, MIN_POWER * q)
words long. Texts of an Arrow batch stand one after the other, a word of its own after each, so that
numpy works on many short texts at once and no run leaves its text.

Small periods (below SCALE) are found by comparing the words with themselves, shifted. Above, at each
dyadic scale t the stretches of t words have hashes; positions whose stretch lies in a found run of
period t / MIN_POWER or less are set aside (that run supplies their period), and of the others those
with the smallest hash of t + 1 neighbours, at either end, are synchronising: equal stretches of 2t
words have them at equal places. A run of period p, t <= p < 2t, is at least 4p long, so two of its
synchronising positions lie p apart with equal 2t words, and none with those words between them: a
position and the next one of equal context propose p, once for each chain. Proposals grow by word
comparison to both sides as far as the period holds, so every reported run is verified word by word.

Cases: a null, empty or blank text has no words and no runs (four nulls, digests of empty strings); a
null id repeats no words; rows of one id are rows of their own; a very long text is one piece (some
100 bytes a word); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm._words import find_words, hash_words, mix, pieces
from murmur.llm.store import small_batches, tidy

MIN_LENGTH, MIN_POWER = 6, 4
#: Periods below it are compared directly; the first scale of the synchronising sets.
SCALE = 8

_NONE = np.uint64(2**64 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Runs:
    start: np.ndarray
    end: np.ndarray
    period: np.ndarray

    def those(self, at: np.ndarray) -> Runs:
        return Runs(self.start[at], self.end[at], self.period[at])


def _joined(parts: list[Runs]) -> Runs:
    return Runs(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("start", "end", "period")))


def _smallest(runs: Runs) -> Runs:
    """A stretch under its smallest period only: a multiple of it holds on the same stretch."""
    order = np.lexsort((runs.period, runs.end, runs.start))
    s, e = runs.start[order], runs.end[order]
    first = np.ones(len(order), bool)
    first[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    return runs.those(order[first])


def shifted_runs(words: np.ndarray, period: int) -> Runs:
    """The maximal stretches of ``words`` with this period, MIN_POWER periods or longer."""
    n = len(words)
    same = np.zeros(max(n - period, 0) + 2, np.int8)
    same[1:-1] = words[:n - period] == words[period:] if n > period else 0
    edge = np.diff(same)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + period
    long_ = end - start >= MIN_POWER * period
    return Runs(start[long_], end[long_], np.full(int(long_.sum()), period, np.int64))


def _doubled(names: np.ndarray, t: int) -> np.ndarray:
    """Hashes of the stretches of 2t words from those of t words; none alike where a stretch leaves the end."""
    n = len(names)
    out = names * _ODD
    if n > t:
        out[:n - t] ^= mix(names[t:] + _ODD)
    out[max(n - t, 0):] ^= np.arange(max(n - t, 0), n).astype(np.uint64) << np.uint64(32)
    return mix(out)


def synchronising(names: np.ndarray, aside: np.ndarray, t: int) -> np.ndarray:
    """Positions i with the smallest name of i .. i + t, or whose i + t has it; ``aside`` ones have no say."""
    n = len(names)
    if n <= t:
        return np.zeros(0, np.int64)
    own = np.where(aside, _NONE, names)
    low, width = own.copy(), 1
    while width < t:  # smallest of 2 * width neighbours
        low[:n - width] = np.minimum(low[:n - width], low[width:])
        width *= 2
    low = np.minimum(low[:n - t], own[t:])
    return np.flatnonzero((low != _NONE) & ((low == own[:n - t]) | (low == own[t:])))


def _aside(runs: Runs, place: np.ndarray, t: int) -> np.ndarray:
    """Which positions begin a stretch of t words inside a run of period t / MIN_POWER or less."""
    step = np.zeros(len(place) + 1, np.int64)
    high = (runs.period * MIN_POWER <= t) & (runs.end - runs.start >= t)
    first, last = runs.start[high], runs.end[high] - t
    at = np.searchsorted(place, first)
    here = at < len(place)
    here[here] = place[at[here]] == first[here]
    np.add.at(step, at[here], 1)
    np.add.at(step, at[here] + (last - first)[here] + 1, -1)
    return np.cumsum(step[:-1]) > 0


def _grown(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of positions equal to the one a period on, as far as it goes to both sides."""
    n, reach = len(words), np.arange(block)
    start, end = start.copy(), end.copy()
    for side in (1, -1):
        open_ = np.arange(len(start))
        while len(open_):
            p = period[open_, None]
            i = end[open_, None] + reach if side > 0 else start[open_, None] - 1 - reach
            real = (i >= 0) & (i + p < n)
            i = np.where(real, i, 0)
            same = real & (words[i] == words[np.minimum(i + p, n - 1)])
            far = np.where(same.all(axis=1), block, same.argmin(axis=1))
            if side > 0:
                end[open_] += far
            else:
                start[open_] -= far
            open_ = open_[far == block]
    return start, end


def _proposed(words: np.ndarray, place: np.ndarray, sync: np.ndarray, context: np.ndarray, doc: np.ndarray, t: int) -> Runs:
    """Runs of period t .. 2t - 1 that pairs of next equal contexts propose."""
    order = np.argsort(context[sync], kind="stable")
    at, same = sync[order], context[sync[order]]
    a, b = at[:-1], at[1:]
    near = (same[1:] == same[:-1]) & (b - a >= t) & (b - a < 2 * t) & (doc[a] == doc[b])
    a, p = place[a[near]], (b - a)[near]
    order = np.lexsort((a, p))
    a, p = a[order], p[order]
    new = np.ones(len(a), bool)  # a chain goes on while the stretches of equal positions meet
    new[1:] = (p[1:] != p[:-1]) | (a[1:] > a[:-1] + 2 * t)
    head = np.flatnonzero(new)
    if not len(head):
        return Runs(a, a, p)
    tail = np.append(head[1:], len(a)) - 1
    start, end, period = a[head], a[tail], p[head]
    parts, chunk = [], max(1, (1 << 20) // t)
    for lo in range(0, len(start), chunk):
        k = slice(lo, lo + chunk)
        # from an anchor, which is verified with the rest, to both sides
        s, e = _grown(words, start[k], start[k], period[k], t)
        parts.append(Runs(s, e + period[k], period[k]))
    runs = _joined(parts)
    broken = runs.end - runs.period < end  # an equal hash of unequal words: the chain's anchors one by one
    if broken.any():
        inside = np.repeat(broken, tail - head + 1)
        s, e = _grown(words, a[inside], a[inside], p[inside], t)
        runs = _joined([runs, Runs(s, e + p[inside], p[inside])])
    return runs.those(runs.end - runs.start >= MIN_POWER * runs.period)


def find_runs(words: np.ndarray, first: np.ndarray) -> Runs:
    """All runs of the texts, by start and period. ``words``: hashes, after each text one that no text
    holds; ``first``: where each text begins, and the end."""
    none = np.zeros(0, np.int64)
    found = _smallest(_joined([Runs(none, none, none), *(shifted_runs(words, p) for p in range(1, SCALE))]))
    size = np.diff(first) - 1
    doc = np.repeat(np.arange(len(size)), size + 1)
    place, names, t, have = np.arange(len(words)), words, 1, len(words)
    while t * MIN_POWER <= size.max(initial=0):
        if t >= SCALE:
            long_ = size >= MIN_POWER * t
            if (size[long_] + 1).sum() * 2 < have:  # the short texts are done with
                keep = long_[doc]
                place, names, doc = place[keep], names[keep], doc[keep]
                have = len(place)
            context = _doubled(names, t)
            sync = synchronising(names, _aside(found, place, t), t)
            found = _smallest(_joined([found, _proposed(words, place, sync, context, doc, t)]))
            names = context
        else:
            names = _doubled(names, t)
        t *= 2
    found = found.those(found.end - found.start >= MIN_LENGTH)
    order = np.lexsort((found.period, found.start))
    return found.those(order)


def source_words(ids: list, counts: np.ndarray) -> dict[int, tuple[int, int]]:
    """Row -> (a, p) of the rows whose words from a repeat the p words from there on."""
    out = {}
    for k, (i, n) in enumerate(zip(ids, counts.tolist())):
        if i is not None and n:
            h = zlib.crc32(str(i).encode())
            if h % 10 == 0:
                g = h // 10
                a = g % n
                out[k] = (a, 1 + (n - a) // (3 + g % 8))
    return out


def collapse(ids: list, column: pa.Array) -> Iterator[tuple]:
    """Per text: number of runs, the longest run's start, length and period (or None), the lines of all
    runs, the kept words."""
    for lo, hi, offsets, data in pieces(column):
        w = find_words(offsets, data)
        counts = w.counts
        repeated = source_words(ids[lo:hi], counts)
        source = np.arange(len(w.starts))
        for k, (a, p) in repeated.items():
            at = int(w.first[k]) + a
            source[at:w.first[k + 1]] = at + np.arange(w.first[k + 1] - at) % p
        # texts apart: after each one a word of its own
        place = np.arange(len(source)) + w.doc
        first = w.first + np.arange(len(w.first))
        words = mix(np.arange(first[-1]).astype(np.uint64) ^ _ODD)
        words[place] = hash_words(data, w.starts, w.ends)[source]
        runs = find_runs(words, first)
        gone = np.zeros(first[-1] + 1, np.int64)
        np.add.at(gone, runs.start + runs.period, 1)
        np.add.at(gone, runs.end, -1)
        gone = np.cumsum(gone)[place] > 0
        of = np.searchsorted(first, runs.start, side="right") - 1
        start, length = runs.start - first[of], runs.end - runs.start
        cut = np.searchsorted(of, np.arange(hi - lo + 1))
        some = np.add.reduceat(np.append(gone, False), w.first[:-1]) if len(w.first) > 1 else np.zeros(0)
        raw = data.tobytes()
        for k in range(hi - lo):
            text = raw[offsets[k]:offsets[k + 1]].split()
            if k in repeated or (counts[k] and some[k]):
                b, e = int(w.first[k]), int(w.first[k + 1])
                text = [text[i] for i in (source[b:e][~gone[b:e]] - b).tolist()]
            at = slice(cut[k], cut[k + 1])
            rows = list(zip(start[at].tolist(), length[at].tolist(), runs.period[at].tolist()))
            best = min(rows, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
            yield len(rows), *best, "".join("%d,%d,%d\n" % r for r in rows).encode(), b" ".join(text)


COLUMNS = ["n_runs", "start", "length", "period"]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """One row per document: id, n_runs, the longest run's start, length, period and exponent_milli, and
    runs (a line ``start,length,period`` each) and collapsed (text without repeats of a run's first
    period), or the SHA-256 of both."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["runs_sha256", "collapsed_sha256"] if digests else ["runs", "collapsed"]
    shown = (lambda b: hashlib.sha256(b).hexdigest()) if digests else bytes.decode

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = [[] for _ in range(6)]
            for row in collapse(b.column(0).to_pylist(), b.column(1)):
                for column, v in zip(out, (*row[:4], shown(row[4]), shown(row[5]))):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in out[:4]), *(pa.array(c, pa.string()) for c in out[4:])],
                                             names=["id", *COLUMNS, *names])

    schema = ", ".join([f"id {kind}", *(f"{c} bigint" for c in COLUMNS), *(f"{c} string" for c in names)])
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(small_batches).mapInArrow(tidy(batches), schema)
    return found.select(F.col("id").alias(id_col), *COLUMNS, F.expr("(1000 * length) div period").alias("exponent_milli"), *names)
