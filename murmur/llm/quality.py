"""Quality rules by repetition coverage.

Per document, rolling hashes of several n-gram lengths (prefix sums of word hashes, in numpy over
an Arrow batch) find n-grams that occurred earlier in the same document; the measure is the share
of word characters that such repeats cover, and the share of characters in repeated lines.

Cases: a null or empty text has no words and fails the base rule; repeated rows and repeated ids
are scored row by row; an empty table gives an empty result; columns beside id and text are not
read by :func:`score` and passed on untouched by :func:`keep`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm._words import RangeHash, code_points, find_words, hash_words, mix, pieces
from murmur.llm.store import small_batches, tidy

MIN_WORDS = 50
#: Base rule: at most this percentage of words in repeated 3-word windows.
MAX_REPEAT_PERCENT = 50
#: n-gram length -> largest share of word characters inside n-grams seen earlier in the document.
MAX_NGRAM_COVER = {5: 0.30, 7: 0.28, 10: 0.25}
#: Largest share of word characters inside lines seen earlier in the document.
MAX_LINE_COVER = 0.30

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]


def _span_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[first])


def _windows(first: np.ndarray, n: int) -> np.ndarray:
    """Starts of the n-word windows that lie inside one document."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return at + np.repeat(first[:-1], counts)


def _repeats(rolling: RangeHash, doc: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows: is it equal to another one of its document; to an earlier one."""
    key = mix(rolling.of(starts, starts + n)) ^ mix(doc[starts].astype(np.uint64) + np.uint64(n << 40))
    ranked = np.sort(key)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    any_, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    if len(twice):
        low, mask = np.zeros(1 << 20, bool), np.uint64((1 << 20) - 1)
        low[twice & mask] = True
        some = np.flatnonzero(low[key & mask])  # the repeated keys and a few others
        order = some[np.argsort(key[some], kind="stable")]
        same = key[order][1:] == key[order][:-1]
        later[order[1:][same]] = any_[order[1:][same]] = any_[order[:-1][same]] = True
    return any_, later


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure(column: pa.Array, ngrams: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The measures of each text of a column."""
    names = [*MEASURES, *(f"dup_{n}gram_chars" for n in ngrams)]
    out = {k: np.zeros(len(column), np.int64) for k in names}
    for lo, hi, offsets, data in pieces(column):
        w = find_words(offsets, data)
        chars = code_points(data)
        size, doc = chars[w.ends] - chars[w.starts], w.doc
        rows = slice(lo, hi)
        out["n_words"][rows] = w.counts
        out["word_chars"][rows] = _span_sums(size, w.first)
        out["n_symbols"][rows] = _span_sums(SYMBOL[data], offsets)
        rolling = RangeHash(hash_words(data, w.starts, w.ends))
        starts = _windows(w.first, 3)
        twice, _ = _repeats(rolling, doc, starts, 3)
        out["n_repeat_words"][rows] = _span_sums(_covered(starts[twice], 3, len(doc)), w.first)
        for n in ngrams:
            starts = _windows(w.first, n)
            _, later = _repeats(rolling, doc, starts, n)
            out[f"dup_{n}gram_chars"][rows] = _span_sums(np.where(_covered(starts[later], n, len(doc)), size, 0), w.first)
        _lines(data, offsets, w, size, out, lo)
    return out


def _lines(data, offsets, w, size, out, lo) -> None:
    raw = data.tobytes()
    total = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=total[1:])
    breaks = np.flatnonzero(data == 10)
    for d, at in enumerate(np.searchsorted(breaks, offsets)[:-1].tolist()):
        a, z = int(offsets[d]), int(offsets[d + 1])
        if a == z:
            continue
        cut = breaks[at:np.searchsorted(breaks, z)]
        if not len(cut):
            continue
        begin, end = np.concatenate([[a], cut + 1]), np.concatenate([cut, [z]])
        i, j = np.searchsorted(w.starts, begin), np.searchsorted(w.starts, end)
        seen, n, chars = set(), 0, 0
        for b, e, p, q in zip(begin.tolist(), end.tolist(), i.tolist(), j.tolist()):
            if p < q:
                line = raw[b:e]
                if line in seen:
                    n += 1
                    chars += int(total[q] - total[p])
                seen.add(line)
        out["n_dup_lines"][lo + d] = n
        out["dup_line_chars"][lo + d] = chars


def verdict(m: dict[str, np.ndarray], ngram_cover: dict[int, float], line_cover: float) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept)"""
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    good = m["dup_line_chars"] <= line_cover * m["word_chars"]
    for n, most in ngram_cover.items():
        good &= m[f"dup_{n}gram_chars"] <= most * m["word_chars"]
    return failed, good & ~failed


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          ngram_cover: dict[int, float] = MAX_NGRAM_COVER, line_cover: float = MAX_LINE_COVER) -> DataFrame:
    """One row per document: id, measures, base_failed, kept."""
    longs = [*MEASURES, *(f"dup_{n}gram_chars" for n in ngram_cover)]
    kind = docs.schema[id_col].dataType.simpleString()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            m = measure(b.column(1), tuple(ngram_cover))
            failed, kept = verdict(m, ngram_cover, line_cover)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(m[k]) for k in longs), pa.array(failed), pa.array(kept)],
                                             names=["id", *longs, "base_failed", "kept"])

    schema = ", ".join([f"id {kind}", *(f"{k} bigint" for k in longs), "base_failed boolean", "kept boolean"])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(small_batches).mapInArrow(tidy(batches), schema).withColumnRenamed("id", id_col)


def keep(docs: DataFrame, text_col: str = "text", ngram_cover: dict[int, float] = MAX_NGRAM_COVER,
         line_cover: float = MAX_LINE_COVER) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    at = docs.columns.index(text_col)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield b.filter(pa.array(verdict(measure(b.column(at), tuple(ngram_cover)), ngram_cover, line_cover)[1]))

    return docs.transform(small_batches).mapInArrow(tidy(batches), docs.schema)
