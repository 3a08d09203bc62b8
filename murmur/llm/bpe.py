"""Byte-level BPE by monoid tree reduction.

Both levels are trees over a monoid. A document is cut in halves down to leaves; a leaf is split by
the pattern, and two neighbours join by re-splitting a growing window over the cut: it begins at the
last piece that no text after the cut can change, and ends where a piece begins at which the right
neighbour also has one (from there the scan sees the same text). Inside a piece, bytes are halved
down to leaves of a few bytes; two token lists join by re-encoding a growing window until its first
and last token form stable pairs with the tokens outside. A token list whose neighbouring pairs all
encode to themselves is the encoding of its bytes, so the tokens outside are then final.
Decoding concatenates up the same kind of tree.

Cases: a null or empty text has no tokens; every row gives one row, repeated rows too; very long
texts and pieces cost n log n; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from murmur.llm.store import small_batches, tidy

LEAF_CHARS = 1 << 16
LEAF_BYTES = 16
NONE = 1 << 62
LEAF_IDS = 1 << 16
#: Pieces and pairs remembered by one worker; others are encoded each time.
REMEMBERED = 100_000
#: The pattern decides a piece from at most this many characters after its start, or from the one after its end.
LOOKAHEAD = 3


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.tokens = {v: k for k, v in ranks.items()}
        self.bytes = [ranks[bytes([i])] for i in range(256)]
        #: (left id << 24 | right id) -> id of the two together
        self.pairs = {(ranks[t[:k]] << 24) | ranks[t[k:]]: r for t, r in ranks.items()
                      for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self._pieces: dict[str, bytes] = {}
        self._stable: dict[tuple[int, int], bool] = {}

    # --- bytes of one piece

    def merge(self, raw: bytes) -> list[int]:
        """Plain BPE: the neighbouring pair of lowest rank first, the leftmost of equals."""
        ranks = self.ranks
        if raw in ranks:
            return [ranks[raw]]
        if len(raw) > 8 * LEAF_BYTES:
            return self._merge_heap(raw)
        parts, rank_of = list(map(self.bytes.__getitem__, raw)), self.pairs.get
        rank = [rank_of((a << 24) | b, NONE) for a, b in zip(parts, parts[1:])]
        while rank and (best := min(rank)) != NONE:
            i = rank.index(best)
            parts[i] = best
            del parts[i + 1], rank[i]
            if i < len(rank):
                rank[i] = rank_of((best << 24) | parts[i + 1], NONE)
            if i:
                rank[i - 1] = rank_of((parts[i - 1] << 24) | best, NONE)
        return parts

    def _merge_heap(self, raw: bytes) -> list[int]:
        ranks, n = self.ranks, len(raw)
        end = list(range(1, n + 1))  # end[i]: where the part that begins at i ends; 0 if none begins there
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not end[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(raw[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (b := before[i]) >= 0 and (r := ranks.get(raw[b:stop])) is not None:
                heapq.heappush(heap, (r, b, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i:end[i]]])
            i = end[i]
        return out

    def stable(self, a: int, b: int) -> bool:
        """Does the pair of tokens encode to itself?"""
        known = self._stable.get((a, b))
        if known is None:
            known = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
            if len(self._stable) < REMEMBERED:
                self._stable[a, b] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        i, j = min(1, len(left)), min(1, len(right))
        while True:
            window = self.merge(b"".join(map(self.tokens.__getitem__, left[len(left) - i:] + right[:j])))
            left_done = i == len(left) or self.stable(left[-i - 1], window[0])
            right_done = j == len(right) or self.stable(window[-1], right[j])
            if left_done and right_done:
                return left[:len(left) - i] + window + right[j:]
            i, j = i if left_done else min(len(left), 2 * i), j if right_done else min(len(right), 2 * j)

    def encode_bytes(self, raw: bytes) -> list[int]:
        if raw in self.ranks:
            return [self.ranks[raw]]
        if len(raw) <= LEAF_BYTES:
            return self.merge(raw)
        half = len(raw) // 2
        return self.join(self.encode_bytes(raw[:half]), self.encode_bytes(raw[half:]))

    def encode_piece(self, piece: str) -> bytes:
        ids = self._pieces.get(piece)
        if ids is None:
            found = self.encode_bytes(piece.encode())
            ids = struct.pack(f"<{len(found)}I", *found)
            if len(self._pieces) < REMEMBERED and len(piece) <= 64:
                self._pieces[piece] = ids
        return ids

    # --- pieces of one document

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(text) <= LEAF_CHARS:
            known, encode = self._pieces.get, self.encode_piece
            return b"".join([known(p) or encode(p) for p in self.split.findall(text)])
        return b"".join(self._tree(text, 0, len(text))[1])

    def _tree(self, text: str, start: int, end: int) -> tuple[list[int], list[bytes]]:
        """Starts of the pieces of text[start:end], and their ids."""
        if end - start <= LEAF_CHARS:
            found = [(m.start(), self.encode_piece(m.group())) for m in self.split.finditer(text, start, end)]
            return [s for s, _ in found], [i for _, i in found]
        half = (start + end) // 2
        (a, a_ids), (b, b_ids) = self._tree(text, start, half), self._tree(text, half, end)
        k = len(a)
        while k and (a[k - 1] + LOOKAHEAD > half or (a[k] if k < len(a) else half) >= half):
            k -= 1  # what follows the cut may change this piece
        at = a[k] if k < len(a) else half
        new, new_ids = [], []
        while True:
            j = bisect_left(b, at)
            if at >= end or at >= half and j < len(b) and b[j] == at:
                return a[:k] + new + b[j:], a_ids[:k] + new_ids + b_ids[j:]
            m = self.split.match(text, at, end)
            new.append(at)
            new_ids.append(self.encode_piece(m.group()))
            at = m.end()


def decode_ids(tokens: dict[int, bytes], ids: list[int]) -> bytes:
    if len(ids) > LEAF_IDS:
        half = len(ids) // 2
        return decode_ids(tokens, ids[:half]) + decode_ids(tokens, ids[half:])
    return b"".join(map(tokens.__getitem__, ids))


def read_ranks(path: str) -> bytes:
    """The vocabulary file, read on the driver; it is sent to the tasks (a few MB at most, whatever the input)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(ranks_file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}


_LOADED: dict[tuple[bytes, str], Bpe] = {}


def load(ranks_file: bytes, pattern: str) -> Bpe:
    """One tokenizer per worker process."""
    key = (hashlib.sha256(ranks_file).digest(), pattern)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(parse_ranks(ranks_file), pattern)
    return _LOADED[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids (binary, little-endian unsigned 32-bit); with
    ``decoded``, also the bytes (binary) decoded from these ids, in the same worker."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(sent.value, pattern)
        for b in it:
            ids = [bpe.encode(t or "") for t in b.column(1).to_pylist()]
            columns = [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([decode_ids(bpe.tokens, np.frombuffer(x, "<u4").tolist()) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids", "decoded"][:len(columns)])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(small_batches)
            .mapInArrow(tidy(batches), f"id {kind}, n_tokens bigint, ids binary" + ", decoded binary" * decoded).withColumnRenamed("id", id_col))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with a column decoded (binary) from its ids."""
    sent = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {v: k for k, v in parse_ranks(sent.value).items()}
        for b in it:
            raw = [decode_ids(tokens, np.frombuffer(x.as_py() or b"", "<u4").tolist()) for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.binary())], names=[*b.schema.names, "decoded"])

    encoded = encoded.drop("decoded")
    at = encoded.columns.index("ids")
    return encoded.transform(small_batches).mapInArrow(tidy(batches), StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))
