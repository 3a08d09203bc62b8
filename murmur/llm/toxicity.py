"""Toxicity by a factorization machine over hashed terms.

Terms are words in lower case and their leading bytes (inflected or compounded forms share them),
hashed to 2**HASH_BITS places; a document has each of its terms once. The score is
sigmoid(w0 + sum of w[i] + sum over pairs of <v[i], v[j]>), so a pair of terms can count that
neither term alone would.

The machine is fitted in numpy on a sample of the labelled rows that is bounded by SAMPLE rows of
each label (those of smallest id hash), whatever the input; every document is scored over its whole
text. Which of the sample's terms and pairs of terms are learnt is counted by Spark: pairs as products of
0/1 matrices (terms x rows) in blocks of terms, so that the work grows with the square of the distinct
frequent terms (at most 2**HASH_BITS), not of a text's length, and the driver gets only the terms kept.
The model is 2**HASH_BITS * (FACTORS + 1) floats, a fixed size, and is sent to the tasks.

Cases: a null or empty text has no terms and scores sigmoid(w0); repeated rows are scored alike; no
labelled rows, or only one label, give a model without terms; rows with equal ids keep the largest
label, and the fit takes the smallest of their texts; a very long text is read whole, as one piece; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm._words import Words, find_words, hash_words, mix, pieces
from murmur.llm.store import drop, small_batches, tidy, tidy_group, written

HASH_BITS = 18
FACTORS = 4
#: Leading bytes of a word that are terms of their own.
PREFIXES = (5, 7)
#: Labelled rows of each label used for the fit, at most.
SAMPLE = 5000
#: Terms in fewer documents of the sample are left out, and those as frequent in both labels
#: (difference of shares below so many standard errors) unless they are apart together with another
#: term (see :func:`together`): over long texts the others only add noise.
MIN_DOCS, MIN_Z = 4, 4.0
#: Chance that any pair without an effect passes, and the range of a pair's expected share of toxic rows.
PAIR_CHANCE, PAIR_SHARE = 0.05, (0.02, 0.98)
#: Terms of a block and rows at a time when pairs are counted; tasks that share the pairs of blocks, at most;
#: kinds of terms compared with all kinds at a time.
BLOCK, ROWS_AT, MOST_TASKS, KINDS_AT = 1024, 1024, 4096, 128
EPOCHS, BATCH, RATE, DECAY = 20, 128, 0.08, 2e-4
#: A toxic row counts as so many in the loss: far fewer rows are toxic.
TOXIC_WEIGHT = 4.0
THRESHOLD = 0.7

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms(offsets: np.ndarray, data: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of the distinct terms, sorted; ``known``: only these places."""
    data = _LOWER[data]
    w: Words = find_words(offsets, data, ~_LETTER)
    doc, parts, docs = w.doc, [], []
    size = w.ends - w.starts
    for n in (0, *PREFIXES):
        some = np.flatnonzero(size > n) if n else np.arange(len(size))
        ends = w.starts[some] + n if n else w.ends
        place = (mix(hash_words(data, w.starts[some], ends) + np.uint64(n)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        d = doc[some]
        if known is not None:
            hit = known[place]
            place, d = place[hit], d[hit]
        parts.append(place)
        docs.append(d)
    key = np.unique((np.concatenate(docs) << HASH_BITS) | np.concatenate(parts))
    return key >> HASH_BITS, key & ((1 << HASH_BITS) - 1)


@dataclass
class Model:
    bias: float
    weight: np.ndarray  # 2**HASH_BITS
    factor: np.ndarray  # 2**HASH_BITS, FACTORS
    known: np.ndarray

    def logits(self, doc: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
        """``doc`` ascending."""
        out = np.full(n, self.bias)
        out += np.bincount(doc, self.weight[place], n)
        for f in range(self.factor.shape[1]):
            v = self.factor[place, f]
            out += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        out = np.empty(len(column))
        for lo, hi, offsets, data in pieces(column):
            out[lo:hi] = self.logits(*terms(offsets, data, self.known), hi - lo)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


@dataclass
class Counts:
    """What a sample says of single terms: its rows and toxic rows, and by place those with the term."""
    rows: int
    ones: int
    seen: np.ndarray
    toxic: np.ndarray

    def alone(self) -> np.ndarray:
        """Places whose shares of the two labels are apart."""
        share, clean = self.seen / self.rows, self.rows - self.ones
        apart = np.abs(self.toxic / self.ones - (self.seen - self.toxic) / clean)
        return (self.seen >= MIN_DOCS) & (apart > MIN_Z * np.sqrt(share * (1 - share) * (1 / self.ones + 1 / clean)))

    def need(self) -> float:
        """The evidence that a pair must reach, among so many pairs."""
        number = np.count_nonzero(self.seen >= MIN_DOCS)
        return float(np.log(max(1, number * (number - 1) / 2) / PAIR_CHANCE))

    def least(self) -> float:
        """Pairs in fewer rows cannot reach it."""
        return max(MIN_DOCS, self.need() / -np.log(PAIR_SHARE[0]))

    def odds(self) -> np.ndarray:
        return np.log((self.toxic + 0.5) / (self.seen - self.toxic + 0.5))

    def share(self, odds: np.ndarray) -> np.ndarray:
        """Expected toxic share of a pair's rows, of the sum of its terms' log odds."""
        return np.clip(1 / (1 + np.exp(np.log(self.ones / (self.rows - self.ones)) - odds)), *PAIR_SHARE)

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Places frequent enough for a pair, those apart alone first, then by frequency; and the pairs (i, j),
        i <= j, of their blocks of BLOCK in which a pair can have enough evidence: it is convex in a pair's toxic
        and clean rows, so it is largest at a corner of what the two terms' rows allow. Terms of equal counts
        are one kind; kinds are consecutive."""
        some = np.flatnonzero(self.seen >= self.least())
        some = some[np.lexsort((self.toxic[some], -self.seen[some], ~self.alone()[some]))]
        new = np.flatnonzero(np.diff(self.seen[some], prepend=-1) | np.diff(self.toxic[some], prepend=-1))
        kind = np.searchsorted(new, np.arange(len(some)), side="right") - 1
        toxic, clean = self.toxic[some[new]], (self.seen - self.toxic)[some[new]]
        odds, alone, need = self.odds()[some[new]], self.alone()[some[new]], self.need()
        begin = kind[::BLOCK]
        end = kind[np.minimum(np.arange(BLOCK, len(some) + BLOCK, BLOCK), len(some)) - 1] + 1
        can = np.zeros((len(begin), len(begin)), bool)
        for i in range(len(begin)):
            hit = np.zeros(len(new) - begin[i], bool)
            for at in range(begin[i], end[i], KINDS_AT):
                x, y = slice(at, min(at + KINDS_AT, end[i])), slice(begin[i], None)
                t, c = np.minimum(toxic[x, None], toxic[y]), np.minimum(clean[x, None], clean[y])
                q = self.share(odds[x, None] + odds[y])
                most = np.maximum(evidence(t, c, q), np.maximum(-t * np.log(q), -c * np.log(1 - q)))
                hit |= ((most > need) & ~(alone[x, None] & alone[y])).any(axis=0)
            upto = np.concatenate([[0], np.cumsum(hit)])
            can[i, i:] = upto[end[i:] - begin[i]] > upto[begin[i:] - begin[i]]
        return some, np.argwhere(can)


def evidence(toxic: np.ndarray, clean: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Exponent of the Chernoff bound for so many toxic and clean rows where ``share`` toxic ones were expected."""
    both = np.maximum(toxic + clean, 1)
    return toxic * np.log(np.maximum(toxic, 1) / both / share) + clean * np.log(np.maximum(clean, 1) / both / (1 - share))


def apart_together(counts: Counts, left: np.ndarray, left_bits: np.ndarray, right: np.ndarray, right_bits: np.ndarray,
                   label: np.ndarray) -> np.ndarray:
    """Places of ``left`` x ``right`` in a pair, not both apart alone, whose rows are toxic more or less often
    than the two terms' own shares explain (added as log odds). The evidence is the exponent of the Chernoff
    bound (:func:`evidence`). ``*_bits``: a term's rows as packed bits; ``label``: of each row, negative for no row. Rows are
    counted as products of 0/1 matrices, a few rows at a time; float32 holds such counts exactly."""
    def products(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, len(rows), ROWS_AT):
            byte, bit = np.divmod(rows[at:at + ROWS_AT], 8)
            x, y = (((bits[:, byte] >> (7 - bit).astype(np.uint8)) & 1).astype(np.float32) for bits in (left_bits, right_bits))
            out += x @ y.T
        return out

    bad = products(np.flatnonzero(label > 0))
    both = products(np.flatnonzero(label == 0)) + bad
    alone, need = counts.alone(), counts.need()
    a, b = np.nonzero(both >= counts.least())
    fresh = (left[a] != right[b]) & ~(alone[left[a]] & alone[right[b]])
    a, b = a[fresh], b[fresh]
    odds = counts.odds()
    q = counts.share(odds[left[a]] + odds[right[b]])
    far = evidence(bad[a, b].astype(float), (both - bad)[a, b].astype(float), q) > need
    return np.unique(np.concatenate([left[a[far]], right[b[far]]]))


def packed(rows: np.ndarray, size: int) -> np.ndarray:
    """Row numbers as ``size`` packed bits."""
    out = np.zeros(size, bool)
    out[rows] = True
    return np.packbits(out)


def together(doc: np.ndarray, place: np.ndarray, label: np.ndarray, counts: Counts) -> np.ndarray:
    """Places of any pair of :func:`apart_together`, of rows held in this process."""
    out = np.zeros(len(counts.seen), bool)
    some, blocks = counts.candidates()
    by = np.argsort(place, kind="stable")
    first, last = (np.searchsorted(place[by], some, side=side) for side in ("left", "right"))
    bits = np.array([packed(doc[by[i:j]], len(label)) for i, j in zip(first, last)]).reshape(len(some), -1)
    for i, j in blocks * BLOCK:
        x, y = slice(i, i + BLOCK), slice(j, j + BLOCK)
        out[apart_together(counts, some[x], bits[x], some[y], bits[y], label)] = True
    return out


def fit(column: pa.Array, label: np.ndarray, seed: int = 7) -> Model:
    """The machine of texts held in this process; :func:`train` does the same by Spark."""
    size = 1 << HASH_BITS
    docs, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, _, offsets, data in pieces(column):
        d, p = terms(offsets, data)
        docs.append(d + lo)
        places.append(p)
    doc, place, n = np.concatenate(docs), np.concatenate(places), len(label)
    known = np.zeros(size, bool)
    if n and label.min() < label.max():
        counts = Counts(n, int(label.sum()), np.bincount(place, minlength=size), np.bincount(place, label[doc], size).astype(np.int64))
        known = counts.alone() | together(doc, place, label, counts)
    return learn(doc, place, label, known, seed)


def learn(doc: np.ndarray, place: np.ndarray, label: np.ndarray, known: np.ndarray, seed: int = 7) -> Model:
    """AdaGrad on the logistic loss. ``doc`` and then ``place`` ascending."""
    n, size = len(label), len(known)
    rng = np.random.default_rng(seed)
    rate = float(label.mean()) if n else 0.1
    m = Model(float(np.log((rate + 0.01) / (1.01 - rate))), np.zeros(size), rng.normal(0, 0.02, (size, FACTORS)) * known[:, None], known)
    hit = known[place]
    doc, place = doc[hit], place[hit]
    first = np.searchsorted(doc, np.arange(n + 1))
    sum_b, sum_w, sum_v = 1e-6, np.full(size, 1e-6), np.full((size, FACTORS), 1e-6)
    for epoch in range(EPOCHS if known.any() else 0):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            rows = order[at:at + BATCH]
            count = first[rows + 1] - first[rows]
            d = np.repeat(np.arange(len(rows)), count)
            i = place[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[rows], count)]
            pull = (1 / (1 + np.exp(-np.clip(m.logits(d, i, len(rows)), -30, 30))) - label[rows]) * np.where(label[rows] > 0, TOXIC_WEIGHT, 1.0) / len(rows)
            used, back = np.unique(i, return_inverse=True)
            g = np.bincount(back, pull[d]) + DECAY * m.weight[used]
            sum_w[used] += g * g
            step = RATE * g / np.sqrt(sum_w[used])
            for f in range(FACTORS):
                v = m.factor[i, f]
                s = np.bincount(d, v, len(rows))
                gv = np.bincount(back, pull[d] * (s[d] - v)) + DECAY * m.factor[used, f]
                sum_v[used, f] += gv * gv
                m.factor[used, f] -= 0.3 * RATE * gv / np.sqrt(sum_v[used, f])
            m.weight[used] -= step
            sum_b += pull.sum() ** 2
            m.bias -= RATE * pull.sum() / np.sqrt(sum_b)
    m.weight, m.factor = m.weight.astype(np.float32), m.factor.astype(np.float32)
    return m


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The machine fitted on the bounded sample. Terms and pairs are counted by Spark; the driver gets the
    labels of the sample, one count a place, and the rows' kept places."""
    spark, size = docs.sparkSession, 1 << HASH_BITS
    marked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
              .withColumn("draw", F.xxhash64("id")))
    picked = [marked.where(F.col("label") == k).orderBy("draw", "id").limit(SAMPLE) for k in (0, 1)]
    # numbers for at most 2 * SAMPLE ids
    picked = picked[0].unionByName(picked[1]).select("id", "label", (F.row_number().over(Window.orderBy("id")) - 1).alias("row"))
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, "id")
             .groupBy("row", "label").agg(F.min("text").alias("text")))
    sample = written(texts.transform(small_batches).mapInArrow(tidy(_row_terms), "row int, label int, places array<int>"), "toxicity-terms")

    ids = sample.select("row", "label").toArrow()
    row, marks = (ids[c].to_numpy().astype(np.int64) for c in ("row", "label"))
    label = np.full(2 * SAMPLE, -1, np.int8)
    label[row] = marks
    known = np.zeros(size, bool)
    if len(set(marks)) == 2:
        found = (sample.select("label", F.explode("places").alias("place")).groupBy("place")
                 .agg(F.count(F.lit(1)).alias("seen"), F.sum("label").alias("toxic")).where(F.col("seen") >= MIN_DOCS).toArrow())
        counts = Counts(len(row), int(marks.sum()), np.zeros(size, np.int64), np.zeros(size, np.int64))
        counts.seen[found["place"].to_numpy()] = found["seen"].to_numpy()
        counts.toxic[found["place"].to_numpy()] = found["toxic"].to_numpy()
        known = counts.alone()
        known[_pairs(sample, counts, label)] = True
    kept = spark.sparkContext.broadcast(known)

    def hits(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            r, p = _flat(b)
            yield pa.RecordBatch.from_arrays([pa.array(x[kept.value[p]].astype(np.int32)) for x in (r, p)], names=["row", "place"])

    left = sample.select("row", "places").mapInArrow(hits, "row int, place int").toArrow()
    drop(sample)
    doc, place = (left[c].to_numpy().astype(np.int64) for c in ("row", "place"))
    order = np.lexsort((place, doc))
    there = np.sort(row)
    return learn(np.searchsorted(there, doc[order]), place[order], label[there].astype(np.float64), known)


def _row_terms(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        for lo, hi, offsets, data in pieces(b.column("text")):
            doc, place = terms(offsets, data)
            upto = pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32))
            lists = pa.ListArray.from_arrays(upto, pa.array(place.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("row").slice(lo, hi - lo), b.column("label").slice(lo, hi - lo), lists], names=["row", "label", "places"])


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of lists of places."""
    lists = b.column("places")
    return np.repeat(b.column("row").to_numpy(), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()


def _pairs(sample: DataFrame, counts: Counts, label: np.ndarray) -> np.ndarray:
    """:func:`together` by Spark: candidates in blocks, each pair of blocks a group. A group holds the packed
    rows of 2 * BLOCK terms, whatever the texts' lengths."""
    spark = sample.sparkSession
    some, blocks = counts.candidates()
    if not len(blocks):
        return some[:0]
    rank = np.full(len(counts.seen), -1, np.int32)
    rank[some] = np.where(np.isin(np.arange(len(some)) // BLOCK, blocks), np.arange(len(some)), -1)
    sent = spark.sparkContext.broadcast((counts, some, rank, label))
    # at most (2**HASH_BITS / BLOCK)**2 rows
    meet = sorted({(k, i, j) for i, j in blocks.tolist() for k in (i, j)})
    meet = F.broadcast(spark.createDataFrame(meet, "block int, lo int, hi int"))

    def ranks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            row, place = _flat(b)
            term = sent.value[2][place]
            yield pa.RecordBatch.from_arrays([pa.array(x[term >= 0]) for x in (term, row)], names=["term", "row"])

    def bits(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = b.column("rows")
            cut, flat = rows.offsets.to_numpy(), rows.values.to_numpy()
            out = [packed(flat[i:j], len(sent.value[3])).tobytes() for i, j in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([b.column("term"), pa.array(out, pa.binary())], names=["term", "bits"])

    def group(t: pa.Table) -> pa.Table:
        counts, some, _, label = sent.value
        block, term = t["block"].to_numpy(), t["term"].to_numpy()
        rows = np.frombuffer(b"".join(t["bits"].to_pylist()), np.uint8).reshape(len(term), -1)
        lo, hi = (block == t[c][0].as_py() for c in ("lo", "hi"))
        out = apart_together(counts, some[term[lo]], rows[lo], some[term[hi]], rows[hi], label)
        return pa.table({"place": pa.array(out.astype(np.int32))})

    posted = sample.select("row", "places").mapInArrow(ranks, "term int, row int").groupBy("term").agg(F.collect_list("row").alias("rows"))
    grouped = (posted.mapInArrow(bits, "term int, bits binary").withColumn("block", F.floor(F.col("term") / BLOCK).cast("int"))
               .join(meet, "block").select("block", "term", "bits", "lo", "hi")
               .repartition(min(len(blocks), MOST_TASKS), "lo", "hi").groupBy("lo", "hi"))
    return grouped.applyInArrow(tidy_group(group), "place int").distinct().toArrow()["place"].to_numpy().astype(np.int64)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sent.value.score(b.column(1)))], names=["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(small_batches).mapInArrow(tidy(batches), f"id {kind}, score double")
            .select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
