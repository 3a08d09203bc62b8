"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: 64 bits, each the majority of that bit over the XXH64 of a text's word shingles.
Equal fingerprints are one node. The upper nodes of the index are masked bit patterns that groups
of fingerprints share: of BLOCKS blocks of bits, two fingerprints at most MAX_BITS apart agree in at
least BLOCKS - MAX_BITS, so each fingerprint stands under the pattern of every such choice of blocks,
and Spark deals patterns to tasks. Under a pattern, fingerprints are sorted by Gray rank, runs of
them form nodes that hold the bits their members share, and runs of nodes form higher nodes. Two
nodes are compared on the bits both hold; the differences accumulate on the way down, and a pair of
nodes beyond the limit is dropped with everything under it.

Cases: a null, empty or blank text has the fingerprint 0, linked like any other; fewer words than a
shingle make one shingle; rows with equal or null ids are rows of their own (a component's id is its
smallest id, null if it has none); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm._words import BLANK, find_words, pieces
from murmur.llm.graph import bounded_cells, components, roots, whole_cells
from murmur.llm.store import small_batches, tidy, written

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Blocks of bits; those that agree make BLOCKS choose MAX_BITS patterns a fingerprint.
BLOCKS = 6
#: Fingerprints under one pattern that meet in one task.
CELL = 1024
#: Members of a lowest node, and children of a higher one.
FAN = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint (uint64) of each text."""
    out = np.zeros(len(column), np.uint64)
    for lo, hi, offsets, data in pieces(column):
        data = _LOWER[data]
        w = find_words(offsets, data)
        if not len(w.starts):
            continue
        keep = ~BLANK[data]
        after = w.ends[w.ends < len(data)]
        keep[after] = True  # one separator after a word; a word after a text's end is another text's
        at = np.zeros(len(data) + 1, np.int64)
        np.cumsum(keep, out=at[1:])
        raw = np.where(BLANK[data], 32, data)[keep].astype(np.uint8).tobytes()
        starts, ends = at[w.starts], at[w.ends]
        count = w.counts
        n = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
        has = np.flatnonzero(n)
        first = np.cumsum(n) - n
        i = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(w.first[:-1], n)
        j = np.minimum(i + shingle, np.repeat(w.first[1:], n)) - 1
        digest, seed = xxhash.xxh64_intdigest, SEED
        h = np.array([digest(raw[a:z], seed) for a, z in zip(starts[i].tolist(), ends[j].tolist())], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first[has], axis=0, dtype=np.int64)
        out[lo + has] = np.packbits(2 * ones > n[has, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each number in the reflected Gray code."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class Index:
    """Fingerprints under one pattern, in Gray order, with the bits that runs of FAN share."""

    def __init__(self, prints: np.ndarray):
        self.levels = [(prints, np.full(len(prints), 2**64 - 1, np.uint64))]  # (pattern, mask), lowest first
        while len(self.levels[-1][0]) > FAN:
            pattern, mask = self.levels[-1]
            at = np.arange(0, len(pattern), FAN)
            held = np.bitwise_and.reduceat(mask, at)
            same = ~(np.bitwise_and.reduceat(pattern, at) ^ np.bitwise_or.reduceat(pattern, at)) & held
            self.levels.append((np.bitwise_and.reduceat(pattern, at) & same, same))

    def pairs(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of members at most ``most`` bits apart, the first before the second."""
        n = len(self.levels[-1][0])
        a, b = np.triu_indices(n, 0 if len(self.levels) > 1 else 1)
        apart = np.zeros(len(a), np.int64)  # differences counted so far
        counted = np.zeros(len(a), np.uint64)  # on these bits
        for k in range(len(self.levels) - 1, -1, -1):
            pattern, mask = self.levels[k]
            both = mask[a] & mask[b]
            apart = apart + np.bitwise_count((pattern[a] ^ pattern[b]) & both & ~counted)
            near = apart <= most
            a, b, apart, counted = a[near], b[near], apart[near], both[near]
            if k:
                size = len(self.levels[k - 1][0])
                a, b = (np.repeat(x, FAN * FAN) for x in (a, b))
                apart, counted = np.repeat(apart, FAN * FAN), np.repeat(counted, FAN * FAN)
                turn = np.arange(len(a)) % (FAN * FAN)
                a, b = a * FAN + turn // FAN, b * FAN + turn % FAN
                real = (a < size) & (b < size) & ((a <= b) if k > 1 else (a < b))
                a, b, apart, counted = a[real], b[real], apart[real], counted[real]
        return a, b


def linked(cell: np.ndarray, prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the components within each cell."""
    order = np.lexsort((gray_rank(prints), cell))
    cell, prints = cell[order], prints[order]
    edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
    size = np.diff(edge)
    firsts, seconds = [], []
    # small groups side by side: each member against the next, the one after, ...
    place = np.arange(len(cell)) - np.repeat(edge[:-1], size)
    rest = np.repeat(size, size) - place
    small = np.repeat(size <= FAN, size)
    for d in range(1, FAN):
        i = np.flatnonzero(small & (rest > d))
        i = i[np.bitwise_count(prints[i] ^ prints[i + d]) <= most]
        firsts.append(i)
        seconds.append(i + d)
    for lo, n in zip(edge[:-1][size > FAN].tolist(), size[size > FAN].tolist()):
        a, b = Index(prints[lo:lo + n]).pairs(most)
        firsts.append(a + lo)
        seconds.append(b + lo)
    a, b = np.concatenate(firsts), np.concatenate(seconds)
    root = roots(len(cell), a, b)
    moved = np.flatnonzero(root != np.arange(len(cell)))
    return prints[moved], prints[root[moved]]


def _links(most: int):
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_cells(it):
            a, b = linked(t["cell"].to_numpy(), t["print"].to_numpy().view(np.uint64), most)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
    return batches


def patterns(blocks: int, most: int) -> list[int]:
    """Masks of every choice of blocks - most blocks."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    block = [((1 << z) - 1) ^ ((1 << a) - 1) for a, z in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(block, blocks - most)]


def near_links(prints: DataFrame, most: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints (column print) that chains of
    pairs at most ``most`` bits apart connect."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    under = F.array(*(F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(patterns(blocks, most))))
    rows = prints.select("print", F.explode(under).alias("pattern"))
    cells = bounded_cells(rows, "pattern", "print", CELL).select("cell", "print")
    return cells.repartition("cell").sortWithinPartitions("cell").transform(small_batches).mapInArrow(tidy(_links(most)), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """One row per document: id, print (long), component_id."""
    kind = docs.schema[id_col].dataType.simpleString()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fingerprints(b.column(1), shingle).view(np.int64))], names=["id", "print"])

    rows = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(small_batches).mapInArrow(tidy(batches), f"id {kind}, print bigint"), "prints")
    nodes = written(rows.groupBy("print").agg(F.min("id").alias("least")), "distinct")
    groups = components(near_links(nodes, most))
    rooted = written(nodes.join(groups.select(F.col("node").alias("print"), "root"), "print", "left")
                     .withColumn("root", F.coalesce("root", "print")), "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    label = written(rooted.join(least, "root").select("print", "component_id"), "labels")
    return rows.join(label, "print").select(F.col("id").alias(id_col), "print", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with all columns: of each component the row with the
    smallest id, and of its rows with that id the one whose text has the smallest hash (equal rows are
    one). Rows of one id in different components all stay if they stand for theirs; rows without an id
    are in no group and stay."""
    named = docs.where(F.col(id_col).isNotNull())
    by_text = lambda d: d.withColumn("_text", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    # under a name of its own the id and the hash identify a text; its component follows from the text
    told = near_duplicates(by_text(named.select(id_col, text_col)).select(F.struct(F.col(id_col).alias("id"), "_text").alias("_of"), text_col), "_of", text_col, shingle, most)
    first = written(told.where(F.col("_of") == F.col("component_id")).select("_of.id", "_of._text").distinct(), "representatives")
    kept = by_text(named).alias("d").join(first.select(F.col("id").alias("_id"), F.col("_text").alias("_hash")),
                                          (F.col(id_col) == F.col("_id")) & (F.col("_text") == F.col("_hash")), "left_semi")
    return kept.dropDuplicates([id_col, "_text"]).select(docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def hex_print(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))
