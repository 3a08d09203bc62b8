"""Token counts of sections by offset-mapped attribution.

A whole document is encoded once. Token lengths give byte spans, and these character spans (a token
inside a character has that character); the spans are joined as intervals to the document's sections.
Rule for a token that crosses a boundary: it counts in the section that has most of its characters,
of equals in the first; a token outside every section counts in none. Sections are the lines of a
text, each with its line feed, so counts add up to the document's; or spans of a column, sorted and
apart from each other.

Cases: a null or empty text is one empty line without tokens; every row is counted, repeated rows
too; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.store import small_batches, tidy

_LOADED: dict[tuple[bytes, str], tuple[tiktoken.Encoding, np.ndarray]] = {}


def load(ranks_file: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder and the byte length of each id; one per worker process."""
    key = (hashlib.sha256(ranks_file).digest(), pattern)
    if key not in _LOADED:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        length = np.zeros(max(ranks.values()) + 1, np.int64)
        length[list(ranks.values())] = [len(t) for t in ranks]
        _LOADED.clear()
        _LOADED[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), length
    return _LOADED[key]


def token_spans(text: str, encoder: tiktoken.Encoding, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token, and the one after its last."""
    ids = np.array(encoder.encode_ordinary(text), np.int64)
    end = np.cumsum(length[ids])
    begin = end - length[ids]
    if text.isascii():
        return begin, end
    raw = np.frombuffer(text.encode(), np.uint8)
    upto = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters begun before a byte
    return upto[begin + 1] - 1 if len(begin) else begin, upto[end]


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the lines, line feeds included."""
    cut = np.cumsum([len(x) + 1 for x in text.split("\n")])
    cut[-1] -= 1
    if len(cut) > 1 and cut[-1] == cut[-2]:
        cut = cut[:-1]  # nothing follows the last line feed
    return np.concatenate([[0], cut[:-1]]), cut


def attribute(begin: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens counted in each section, and tokens that touch it and another section or a gap."""
    counted, crossing = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
    i, j = np.searchsorted(hi, begin, side="right"), np.searchsorted(lo, end, side="left") - 1  # touched: i..j
    inside = (i == j) & (i < len(lo))
    inside[inside] = (lo[i[inside]] <= begin[inside]) & (end[inside] <= hi[i[inside]])
    np.add.at(counted, i[inside], 1)
    for t in np.flatnonzero(~inside & (i <= j)).tolist():
        some = np.arange(i[t], j[t] + 1)
        shared = np.minimum(hi[some], end[t]) - np.maximum(lo[some], begin[t])
        counted[some[np.argmax(shared)]] += 1
        crossing[some[shared > 0]] += 1
    return counted, crossing


def token_counts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 sections_col: str | None = None) -> DataFrame:
    """One row per section: id, section (from 0), begin, end (characters), n_tokens, n_crossing, doc_tokens.
    ``sections_col``: array<struct<begin: bigint, end: bigint>>; else lines."""
    with open(ranks_path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary, whatever the input

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, length = load(sent.value, pattern)
        for b in it:
            texts = b.column(1).to_pylist()
            given = b.column(2).to_pylist() if sections_col else [None] * len(texts)
            for at in range(0, len(texts), 256):
                row, out = [], [[] for _ in range(6)]
                for k, (text, spans) in enumerate(zip(texts[at:at + 256], given[at:at + 256]), at):
                    text = text or ""
                    begin, end = token_spans(text, encoder, length)
                    lo, hi = lines(text) if not sections_col else tuple(
                        np.array([s[c] for s in spans or []], np.int64) for c in ("begin", "end"))
                    n, crossing = attribute(begin, end, lo, hi)
                    row.append(np.full(len(lo), k))
                    for x, y in zip(out, (np.arange(len(lo)), lo, hi, n, crossing, np.full(len(lo), len(begin)))):
                        x.append(y)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(row))), *(pa.array(np.concatenate(x).astype(np.int64)) for x in out)],
                                                 names=["id", "section", "begin", "end", "n_tokens", "n_crossing", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    columns = [F.col(id_col).alias("id"), F.col(text_col).alias("text"), *([F.col(sections_col).alias("sections")] if sections_col else [])]
    return docs.select(*columns).transform(small_batches).mapInArrow(
        tidy(batches), f"id {kind}, section bigint, begin bigint, end bigint, n_tokens bigint, n_crossing bigint, doc_tokens bigint").withColumnRenamed("id", id_col)
