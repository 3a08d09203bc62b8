"""Ranked lexical search by dense blocked BLAS multiplication.

Items come in blocks of a bounded number of (item, term) pairs. For a block, every document becomes
its occurrences of the block's terms; document frequencies and lengths are sums over all documents.
A tile of items has a compact vocabulary, cut into tiles of terms; the weights (items x terms) are
multiplied with the impacts (terms x documents) of a tile of documents in float64. Weights and impacts
are integers and a tile's terms are few enough that every partial sum stays below 2**53, so the
products are exact in any order of summation; tiles are added in 64-bit integers. Each tile of
documents gives an item's best ones, with the smallest ids among equal scores, a task the best of its
tiles, and two windows (first by item and salt) the best of all.

Score: sum of w * ((10**9 * tf) div (1000 * tf + 12 * m)) over an item's terms, repeats included, with
w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 75 + (25 * n * N) div L.

Cases: a null or empty text has no terms: such a document is found by nothing and not counted, such an
item has no rows; rows of one item id (null too) are one item with all their terms; rows of one
document id are documents of their own, a null id comes after all others among equal scores; a very
long text is worked on whole; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm._words import find_words, hash_words, pieces
from murmur.llm.store import small_batches, tidy, written

TOP = 20
#: Percent of a document's length in its impact's denominator; factors of the impact.
LENGTH_PERCENT, IMPACT, TF, NORM = 25, 10**9, 1000, 12
#: Terms and documents of a tile, items of a tile.
TERMS, DOCS, ITEMS = 2048, 1024, 256
#: (item, term) pairs of a block: what is sent to a task. A single item with more is a block of its own.
BLOCK_PAIRS = 1 << 20
#: Weights of a tile's terms add up to less in any item, and impacts are below IMPACT / TF.
MOST_WEIGHT = 2**53 // (IMPACT // TF)
#: Parts in which an item's candidates are ranked first.
SALTS = 16

_APART = np.zeros(256, bool)
_APART[:48] = _APART[58:65] = _APART[91:97] = _APART[123:128] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, row of each term, hash of each term) of runs of texts."""
    for lo, hi, offsets, data in pieces(column):
        data = _LOWER[data]
        w = find_words(offsets, data, _APART)
        yield lo, hi, w.doc, hash_words(data, w.starts, w.ends).view(np.int64)


def item_pairs(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term: hash, times)"""
    kind = items.schema[item_col].dataType.simpleString()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for lo, _, row, term in _terms(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row + lo)), pa.array(term)], names=["item", "term"])

    rows = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    return rows.transform(small_batches).mapInArrow(tidy(batches), f"item {kind}, term bigint").groupBy("item", "term").agg(F.count("*").alias("times"))


def blocks(pairs: DataFrame, limit: int) -> DataFrame:
    """``pairs`` with ``block``: at most ``limit`` pairs each, or one item."""
    sizes = written(pairs.groupBy("item").agg(F.count("*").alias("n")), "items")
    large = F.col("n") > limit // 4
    number = max(1, 2 * (sizes.where(~large).agg(F.sum("n")).first()[0] or 0) // limit)
    while True:
        dealt = sizes.withColumn("block", F.when(large, F.concat(F.lit("item "), F.coalesce(F.col("item").cast("string"), F.lit(""))))
                                 .otherwise(F.pmod(F.xxhash64("item"), F.lit(number)).cast("string")))
        if (dealt.where(~large).groupBy("block").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0) <= limit:
            break
        number *= 2
    dealt = dealt.select(F.col("item").alias("of"), "block")
    return pairs.join(dealt, pairs["item"].eqNullSafe(dealt["of"])).drop("of")


def occurrences(docs: DataFrame, vocabulary: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, n: terms, slots, times): the places in ``vocabulary`` (sorted hashes) of a text's terms, and
    how often each occurs, as 32-bit integers."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for lo, hi, row, term in _terms(b.column(1)):
                slot = np.searchsorted(vocabulary, term)
                hit = vocabulary[np.minimum(slot, len(vocabulary) - 1)] == term
                key, times = np.unique(row[hit] * len(vocabulary) + slot[hit], return_counts=True)
                ends = np.searchsorted(key, np.arange(hi - lo + 1) * len(vocabulary)).astype(np.int32) * 4
                binary = lambda v: pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends), pa.py_buffer(v.astype("<i4"))])  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(np.bincount(row, minlength=hi - lo)),
                                                  binary(key % len(vocabulary)), binary(times)], names=["id", "n", "slots", "times"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.transform(small_batches).mapInArrow(tidy(batches), "id bigint, n bigint, slots binary, times binary")


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a column of 32-bit integers in binary."""
    _, off, data = column.buffers()
    ends = np.frombuffer(off, np.int32)[column.offset:column.offset + len(column) + 1] // 4 if len(column) else np.zeros(1, np.int32)
    values = np.frombuffer(data, "<i4")[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.int32)
    return ends - ends[0], values


def frequencies(found: DataFrame, size: int) -> np.ndarray:
    """Documents with each term of a vocabulary of ``size`` terms."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in it:
            total += np.bincount(_numbers(b.column(0))[1], minlength=size)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], names=["slot", "df"])

    sums = found.select("slots").mapInArrow(batches, "slot bigint, df bigint").groupBy("slot").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[sums["slot"].to_numpy()] = sums["df"].to_numpy()
    return out


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    if LENGTH_PERCENT * int(n.max(initial=0)) * documents < 2**63:
        share = LENGTH_PERCENT * n * documents // length
    else:  # beyond 64 bits
        share = np.array([LENGTH_PERCENT * int(x) * documents // length for x in n], np.int64)
    return IMPACT * tf // (TF * tf + NORM * (100 - LENGTH_PERCENT + share))


@dataclass
class Tile:
    """Weights of some items and terms. A slot stands twice where its weight is dealt over two tiles."""
    slots: np.ndarray
    item: np.ndarray
    column: np.ndarray
    weight: np.ndarray


def tiles(item: np.ndarray, slot: np.ndarray, weight: np.ndarray, terms: int = TERMS, most: int = MOST_WEIGHT) -> list[Tile]:
    """The weights of a tile of items, its terms in tiles whose weights add up to ``most`` at most in any item."""
    out: list[Tile] = []
    while len(slot):
        part = np.minimum(weight, most)
        own, column = np.unique(slot, return_inverse=True)
        high = np.zeros(len(own), np.int64)
        np.maximum.at(high, column, part)
        cut, lo = [0], 0
        upto = np.cumsum(high)
        while lo < len(own):
            lo = max(lo + 1, min(lo + terms, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, side="right"))))
            cut.append(lo)
        for a, z in zip(cut, cut[1:]):
            at = (column >= a) & (column < z)
            out.append(Tile(own[a:z], item[at], column[at] - a, part[at]))
        left = weight > most
        item, slot, weight = item[left], slot[left], weight[left] - most
    return out


def tile_scores(of: list[Tile], items: int, vocabulary: int, doc: np.ndarray, slot: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
    """(items x documents) scores of the documents' occurrences (doc, slot, impact)."""
    total, column = np.zeros((items, docs), np.int64), np.full(vocabulary, -1, np.int32)
    for t in of:
        column[t.slots] = np.arange(len(t.slots))
        at = column[slot]
        hit = np.flatnonzero(at >= 0)
        column[t.slots] = -1
        if len(hit):
            left, right = np.zeros((items, len(t.slots))), np.zeros((len(t.slots), docs))
            left[t.item, t.column] = t.weight
            right[at[hit], doc[hit]] = impact[hit]
            total += (left @ right).astype(np.int64)
    return total


def best_of_tile(scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's highest scores above 0; of equal ones the first columns."""
    if scores.shape[1] <= top:
        return np.nonzero(scores > 0)
    bound = np.partition(scores, scores.shape[1] - top, axis=1)[:, scores.shape[1] - top, None]
    above, equal = scores > bound, scores == bound
    room = top - above.sum(axis=1, keepdims=True)
    return np.nonzero((above | equal & (np.cumsum(equal, axis=1) <= room)) & (scores > 0))


def _best(item: np.ndarray, score: np.ndarray, id_: np.ndarray, null: np.ndarray, top: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((id_, null, -score, item))
    item = item[order]
    place = np.arange(len(item)) - np.searchsorted(item, item)
    keep = order[place < top]
    return item[place < top], score[keep], id_[keep], null[keep]


def candidates(found: DataFrame, item: np.ndarray, slot: np.ndarray, weight: np.ndarray, vocabulary: int,
               documents: int, length: int, top: int) -> DataFrame:
    """(item: number, score, id): the best documents of each task. ``item`` ascends."""
    edge = [0, *np.searchsorted(item, np.arange(ITEMS, item[-1] + 1, ITEMS)).tolist(), len(item)]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [tiles(item[a:z] - ITEMS * k, slot[a:z], weight[a:z]) for k, (a, z) in enumerate(zip(edge, edge[1:]))]
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        for b in it:
            b = b.filter(pa.array(np.diff(_numbers(b.column(2))[0]) > 0))
            for lo in range(0, b.num_rows, DOCS):
                part = b.slice(lo, DOCS)
                null = part.column(0).is_null().to_numpy(zero_copy_only=False)
                ids, n = part.column(0).fill_null(0).to_numpy(), part.column(1).to_numpy()
                ends, slots = _numbers(part.column(2))
                tf = _numbers(part.column(3))[1].astype(np.int64)
                doc = np.repeat(np.arange(len(ids)), np.diff(ends))
                order = np.lexsort((ids, null))  # columns by id, so that of equal scores the first ones count
                at = np.empty(len(ids), np.int64)
                at[order] = np.arange(len(ids))
                impact = impacts(tf, n[doc], documents, length)
                new = [held]
                for k, tile in enumerate(own):
                    scores = tile_scores(tile, ITEMS, vocabulary, at[doc], slots, impact, len(ids))
                    i, j = best_of_tile(scores, top)
                    new.append((i + ITEMS * k, scores[i, j], ids[order[j]], null[order[j]]))
                held = _best(*(np.concatenate(x) for x in zip(*new)), top)
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1]), pa.array(held[2], mask=held[3])], names=["number", "score", "id"])

    return found.transform(small_batches).mapInArrow(tidy(batches), "number bigint, score bigint, id bigint")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "score"), F.lit(SALTS)))
    for keys in (["number", "salt"], ["number"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return rows.drop("salt")


def search(items: DataFrame, docs: DataFrame, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text",
           top: int = TOP, limit: int = BLOCK_PAIRS) -> DataFrame:
    """(item, rank, id, score) of each item's ``top`` documents. Document ids are integers."""
    spark = items.sparkSession
    pairs = written(blocks(written(item_pairs(items, item_col, text_col), "pairs"), limit), "blocks")
    kind = items.schema[item_col].dataType.simpleString()
    out = [spark.createDataFrame([], f"{item_col} {kind}, rank int, {id_col} bigint, score bigint")]
    for block in sorted(r["block"] for r in pairs.select("block").distinct().collect()):
        own = pairs.where(F.col("block") == block).select("item", "term", "times").toArrow()  # bounded: a block
        names = own["item"].combine_chunks().dictionary_encode(null_encoding="encode")
        number = names.indices.to_numpy().astype(np.int64)
        vocabulary, slot = np.unique(own["term"].to_numpy(), return_inverse=True)
        found = written(occurrences(docs, vocabulary, id_col, text_col), "occurrences")
        documents, length = found.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not length:
            continue
        df = frequencies(found, len(vocabulary))
        w = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        order = np.lexsort((slot, number))
        weight = (w[slot] * own["times"].to_numpy())[order]
        ranked = _ranked(candidates(found, number[order], slot[order], weight, len(vocabulary), documents, length, top), top)
        ids = spark.createDataFrame(pa.table({"number": np.arange(len(names.dictionary)), "item": names.dictionary}))
        out.append(ranked.join(F.broadcast(ids), "number").select(F.col("item").cast(kind).alias(item_col), F.col("rank").cast("int").alias("rank"),
                                                                 F.col("id").alias(id_col), "score"))
    return reduce(DataFrame.union, out[1:] or out)
