"""Substring dedup by recompression: words inside windows whose word sequence occurs earlier go.

Documents are packed into compressed packs, written once. Three rounds cross the cluster, each a
shuffle of names by bucket and back:

1. Every pack names its runs and pairs (``recompress``). Names of level LOW that only one pack has,
   once, prove that each window holding their context is unique. High-level names that stand
   earlier elsewhere reveal long repeats at once: every window inside such a symbol is a repeat, and
   none of them is the first of its kind.
2. The windows left over are named by two independent hashes (96 bits are compared) and their first
   place is found: that settles the ends of repeats and what no symbol could tell.
3. Words covered by repeated windows are removed.

A name crosses once per pack, so a passage in a third of all documents is no hot key; buckets are
ranges of the hash and even. "Earlier" is by id, then by the order of rows in the packs, then by place.

Cases: a null, empty or short text has no windows and keeps its words; null ids come last; documents
with equal ids are separate documents, compared in pack order; very long texts are a pack of their
own; an empty table gives an empty result; the other columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from murmur.llm._words import RangeHash, Words, find_words, hash_words, mix, text_buffers
from murmur.llm.recompress import Level, rounds
from murmur.llm.store import small_batches, tidy, tidy_group, written

WINDOW = 20
#: Text bytes in a pack: what one task holds at a time. Larger packs make fewer, larger rows.
PACK_BYTES = 2 << 20
#: Words whose names meet in one bucket, about; the number of buckets is a power of two, 256 or more.
BUCKET_WORDS = 1 << 21
LOW = 4
HIGH = (12, 15, 18, 21, 24)

_PACK = "pack bigint, n_words bigint, rows binary"
_KEYS = "bucket int, pack bigint, base bigint, low binary, high binary, ids binary"
_BITS = "pack bigint, bucket int, low binary, high binary"


# --- packs

def packs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text_at, id_at = docs.columns.index(text_col), docs.columns.index(id_col)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for b in it:
            lo = 0
            ends = text_buffers(b.column(text_at))[0]
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PACK_BYTES - size, side="right")) - 1)
                held.append(b.slice(lo, hi - lo))
                size += int(ends[hi] - ends[lo])
                lo = hi
                if size >= PACK_BYTES or lo < b.num_rows:
                    yield _packed(number, held, text_at, id_at)
                    number, held, size = number + 1, [], 0
        if held:
            yield _packed(number, held, text_at, id_at)

    return written(docs.transform(small_batches).mapInArrow(tidy(batches), _PACK), "packs")


def _packed(number: int, held: list[pa.RecordBatch], text_at: int, id_at: int) -> pa.RecordBatch:
    t = pa.Table.from_batches(held).combine_chunks()
    t = t.take(pa.array(np.argsort(_ids(t.column(id_at)), kind="stable")))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
        w.write_table(t)
    offsets, data = text_buffers(t.column(text_at))
    n = len(find_words(offsets, data).starts)
    return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([n]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                      names=["pack", "n_words", "rows"])


def _ids(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(column.cast(pa.int64()), 2**63 - 1).to_numpy(zero_copy_only=False)


@dataclass
class Pack:
    table: pa.Table
    data: np.ndarray
    words: Words
    ids: np.ndarray  # of each document
    doc: np.ndarray  # of each word
    one: RangeHash
    two: RangeHash
    low: Level
    high: Level  # of all levels of HIGH, with at least a window's words

    @classmethod
    def open(cls, blob: bytes, text_at: int, id_at: int, window: int) -> Pack:
        t = pa.ipc.open_stream(pa.BufferReader(blob)).read_all().combine_chunks()
        offsets, data = text_buffers(t.column(text_at))
        w = find_words(offsets, data)
        h, doc = hash_words(data, w.starts, w.ends), w.doc
        one, two = RangeHash(h), RangeHash(mix(h + np.uint64(0x632BE59BD9B4E019)), 0xAEF17502108EF2D9)
        low, high = None, []
        for number, level in enumerate(rounds(h, doc, w.first, one, max(HIGH)), 1):
            if number == LOW:
                some = level.high - level.low <= window
                low = Level(*(x[some] for x in (level.start, level.end, level.low, level.high)))
            elif number in HIGH:
                some = level.end - level.start >= window
                high.append((level.start[some], level.end[some]))
        start, end = (np.concatenate(x) for x in zip(*high))
        return cls(t, data, w, _ids(t.column(id_at)), doc, one, two, low, Level(start, end, start, end))

    def low_names(self) -> np.ndarray:
        """48 bits."""
        return mix(self.one.of(self.low.start, self.low.end) + np.uint64(1)) >> np.uint64(16)

    def names(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent names of word ranges, 48 bits each."""
        return mix(self.one.of(start, end) + np.uint64(2)) >> np.uint64(16), mix(self.two.of(start, end)) >> np.uint64(16)


# --- names of a pack, by bucket

def _first_of_each(name: np.ndarray, other: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the first place of each distinct name, by name; and for every index, which of these it equals."""
    order = np.lexsort((place, other, name))
    a, b = name[order], other[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
    which = np.empty(len(a), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def _bytes(x: np.ndarray, n: int) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n])


def _numbers(raw: bytes, n: int, skip: int = 0, width: int | None = None) -> np.ndarray:
    """Unsigned numbers of n bytes from rows of ``width`` bytes."""
    rows = np.frombuffer(raw, np.uint8).reshape(-1, width or n)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :n] = rows[:, skip:skip + n]
    return out.view("<u8")[:, 0]


def _key_rows(number: int, bits: int, low: np.ndarray, name: np.ndarray, other: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """``low`` and ``name`` ascending, 48 bits; a bucket is their leading ``bits`` (8 or more), which
    its rows leave out with the rest of the first byte."""
    edge = np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(48 - bits)
    i, j = np.searchsorted(low, edge), np.searchsorted(name, edge)
    low, both = _bytes(low, 5), np.concatenate([_bytes(name, 5), _bytes(other, 6)], axis=1)
    base = int(ids.min()) if len(ids) else 0
    # offsets from the smallest id, in as few bytes as they need; modulo 2**64
    off = ids.astype(np.uint64) - np.uint64(base % 2**64)
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(off) or int(off.max()) < 1 << (8 * w))
    off = _bytes(off, width)
    full = np.flatnonzero((np.diff(i) > 0) | (np.diff(j) > 0))
    cut = lambda x, at: pa.array([x[at[k]:at[k + 1]].tobytes() for k in full.tolist()], pa.binary())
    n = len(full)
    return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(np.full(n, number)), pa.array(np.full(n, base)),
                                       cut(low, i), cut(both, j), cut(off, j)],
                                      names=["bucket", "pack", "base", "low", "high", "ids"])


def _symbol_keys(p: Pack) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    name, other = p.names(p.high.start, p.high.end)
    first, _ = _first_of_each(name, other, p.high.start)
    return np.unique(p.low_names()), (name[first], other[first], p.ids[p.doc[p.high.start[first]]])


def _spread(at: np.ndarray, past: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any [at, past)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, past, -1)
    return np.cumsum(step)[:n] > 0


def _windows(p: Pack, repeated: np.ndarray, earlier: np.ndarray, window: int):
    """After the first round: (windows known to be repeats of earlier ones; starts of the open ones,
    the first of each name among them, and which of these each equals; the names of these)."""
    n = len(p.doc)
    low = p.low_names()
    distinct, which, count = np.unique(low, return_inverse=True, return_counts=True)
    alone = ((count == 1) & ~repeated)[which]
    unique = _spread(np.maximum(p.low.high[alone] - window, 0), p.low.low[alone] + 1, n)
    name, other = p.names(p.high.start, p.high.end)
    first, which = _first_of_each(name, other, p.high.start)
    late = earlier[which] | (p.high.start != p.high.start[first][which])  # levels may share a symbol
    dead = _spread(p.high.start[late], p.high.end[late] - window + 1, n)
    fits = np.zeros(n, bool)
    fits[:max(0, n - window + 1)] = p.doc[:max(0, n - window + 1)] == p.doc[window - 1:]
    at = np.flatnonzero(fits & ~unique & ~dead)
    name, other = p.names(at, at + window)
    first, which = _first_of_each(name, other, at)
    return dead & fits, at, first, (name[first], other[first], p.ids[p.doc[at[first]]])


def _answer(t: pa.Table) -> pa.Table:
    """One bucket: for every name of every pack, is the low one in other packs too; is the high one
    in an earlier document."""
    rows = t.select(["pack", "base", "low", "high", "ids"]).to_pylist()
    lows = [_numbers(r["low"], 5) for r in rows]
    every = np.concatenate(lows)
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    twice = np.zeros(len(every), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    n = [len(r["high"]) // 11 for r in rows]
    name = np.concatenate([_numbers(r["high"], 5, 0, 11) for r in rows])
    other = np.concatenate([_numbers(r["high"], 6, 5, 11) for r in rows])
    ids = np.concatenate([(_numbers(r["ids"], len(r["ids"]) // k) if k else np.zeros(0, np.uint64)).astype(np.int64) + np.int64(r["base"])
                          for r, k in zip(rows, n)])
    number = np.repeat(np.array([r["pack"] for r in rows], np.int64), n)
    order = np.lexsort((number, ids, other, name))
    a, b = name[order], other[order]
    earlier = np.zeros(len(name), bool)
    earlier[order[1:][(a[1:] == a[:-1]) & (b[1:] == b[:-1])]] = True
    cut = lambda x, sizes: pa.array([np.packbits(y).tobytes() for y in np.split(x, np.cumsum(sizes)[:-1])], pa.binary())
    return pa.Table.from_arrays([t["pack"], t["bucket"], cut(twice, [len(x) for x in lows]), cut(earlier, n)], names=["pack", "bucket", "low", "high"])


def _bits(t: pa.Table, column: str, keys: np.ndarray, bits: int) -> np.ndarray:
    """The answers of all buckets in the order of the (ascending) keys."""
    out = np.zeros(len(keys), bool)
    edge = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(48 - bits))
    for bucket, raw in zip(t["bucket"].to_pylist(), t[column].to_pylist()):
        if raw:
            lo, hi = edge[bucket], edge[bucket + 1]
            out[lo:hi] = np.unpackbits(np.frombuffer(raw, np.uint8), count=hi - lo)
    return out


# --- the rounds

def _with_answers(stored: DataFrame, *answers: DataFrame) -> DataFrame:
    """Packs and the answers to them, by pack: kind 0 is the pack, k the answers of round k."""
    empty = F.lit(None).cast("binary")
    rows = stored.select("pack", F.lit(0).alias("kind"), F.lit(-1).alias("bucket"), "rows", empty.alias("low"), empty.alias("high"))
    for k, a in enumerate(answers, 1):
        rows = rows.unionByName(a.select("pack", F.lit(k).alias("kind"), "bucket", empty.alias("rows"), "low", "high"))
    return rows.groupBy("pack")


def removals(docs: DataFrame, id_col: str, text_col: str, window: int, output, schema: StructType) -> DataFrame:
    """``output(pack, removed words)`` of every pack, as rows of ``schema``."""
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    stored = packs(docs, id_col, text_col)
    total = stored.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    bits = max(8, int(total // BUCKET_WORDS).bit_length())

    def name_symbols(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for number, blob in zip(b["pack"].to_pylist(), b["rows"]):
                low, high = _symbol_keys(Pack.open(blob.as_py(), text_at, id_at, window))
                yield _key_rows(number, bits, low, *high)

    def opened(t: pa.Table):
        kind = t["kind"].to_numpy()
        p = Pack.open(t["rows"][int(np.flatnonzero(kind == 0)[0])].as_py(), text_at, id_at, window)
        answers = t.filter(pa.array(kind == 1))
        low, (name, _, _) = _symbol_keys(p)
        found = _windows(p, _bits(answers, "low", low, bits), _bits(answers, "high", name, bits), window)
        return p, found, t.filter(pa.array(kind == 2))

    def name_windows(t: pa.Table) -> pa.Table:
        _, (_, _, _, keys), _ = opened(t)
        return pa.Table.from_batches([_key_rows(t["pack"][0].as_py(), bits, np.zeros(0, np.uint64), *keys)])

    def remove(t: pa.Table) -> pa.Table:
        p, (dead, at, first, (name, _, _)), answers = opened(t)
        late = np.ones(len(at), bool)
        late[first] = _bits(answers, "high", name, bits)
        begin = np.concatenate([np.flatnonzero(dead), at[late]])
        return output(p, _spread(begin, begin + window, len(p.doc)))

    symbols = stored.select("pack", "rows").transform(small_batches).mapInArrow(tidy(name_symbols), _KEYS).groupBy("bucket").applyInArrow(tidy_group(_answer), _BITS)
    symbols = written(symbols, "symbols")
    windows = written(_with_answers(stored, symbols).applyInArrow(tidy_group(name_windows), _KEYS).groupBy("bucket").applyInArrow(tidy_group(_answer), _BITS), "windows")
    return _with_answers(stored, symbols, windows).applyInArrow(tidy_group(remove), schema)


def _kept_texts(p: Pack, removed: np.ndarray) -> list[str]:
    """The kept words of each document, joined by one blank."""
    raw, w = p.data.tobytes(), p.words
    out = []
    for a, z in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        keep = ~removed[a:z]
        out.append(b" ".join([raw[i:j] for i, j in zip(w.starts[a:z][keep].tolist(), w.ends[a:z][keep].tolist())]).decode())
    return out


def _counts(p: Pack, removed: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(removed)])
    return np.diff(total[p.words.first])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept (its words that stay, joined by one blank)."""
    docs = docs.select(id_col, text_col)

    def output(p: Pack, removed: np.ndarray) -> pa.Table:
        return pa.Table.from_arrays([p.table.column(0), pa.array(p.words.counts), pa.array(_counts(p, removed)),
                                     pa.array(_kept_texts(p, removed), pa.string())], names=[id_col, "n_words", "n_removed", "kept"])

    schema = StructType([docs.schema[id_col], StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())])
    return removals(docs, id_col, text_col, window, output, schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    length_col: str | None = None) -> DataFrame:
    """``docs`` with repeats removed from the texts; a text without any stays as it is."""
    names = docs.columns
    at = names.index(text_col)

    def output(p: Pack, removed: np.ndarray) -> pa.Table:
        gone = _counts(p, removed)
        old = p.table.column(at).to_pylist()
        new = [k if n else o for k, n, o in zip(_kept_texts(p, removed), gone.tolist(), old)]
        t = p.table.set_column(at, text_col, pa.array(new, pa.string()))
        if length_col is not None:
            i = names.index(length_col)
            was = t.column(i).to_pylist()
            t = t.set_column(i, length_col, pa.array([len(x) if n else o for x, n, o in zip(new, gone.tolist(), was)], t.schema.field(i).type))
        return t

    return removals(docs, id_col, text_col, window, output, docs.schema)
