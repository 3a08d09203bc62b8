"""Masked pseudo-likelihood: every word is predicted from the words on both sides of it.

Words (lower case) are counted by their whole 64-bit hash in a Spark table. The HEAD most frequent
words (a fixed bound, sent to the tasks) are dealt to classes of about equal mass; the words beyond
are dealt by hash to classes of their own, and their counts are joined from the table. A word's
conditional probability is that of its class given both sides, from the network, times the word's
share of the class, from the counts. The network adds up the embeddings of SIDE words on each side,
each with weights of its offset, and has one hidden layer; it is trained in numpy.

What is learnt grows with the corpus: the counts with its distinct words, the classes with their power
of 0.3, the input places with their square root, the width with their logarithm (see :func:`sizes`).
Every document trains, in one of several rounds by the hash of its text: the tasks of a round train
copies on the texts of their partitions, whose mean (weighted by words, added up in a tree of groups)
is the start of the next round. The number of rounds grows with the logarithm of the words.

Cases: a null or empty text has no words, log_prob 0 and no mean; words missing beyond a text's ends
are an "outside" place; a word that was not counted has the mass of half a word in its class; rows are
scored one by one, repeated rows alike (also null and repeated ids); whole texts are read, a very long
one as one piece in one task; an empty table gives an empty result and trains nothing; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm._words import find_words, hash_words, mix, pieces
from murmur.llm.store import small_batches, tidy, tidy_group, written

#: Words whose counts are sent to every task.
HEAD = 1 << 16
#: Mass of all words of a class that were not counted.
UNSEEN = 0.5
SIDE = 2
BATCH, RATE = 512, 0.5
#: Words of the first rounds; four times as many words are one more round.
ROUND_WORDS = 1 << 22
#: Parameters of a copy are summed in pieces of so many, and so many copies (a power of two) at a time.
BLOCK, FAN_BITS = 1 << 14, 6

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]


def sizes(distinct: int) -> tuple[int, int, int]:
    """(classes, input places, width) for so many distinct words."""
    v = max(2, distinct)
    return max(32, round(v ** 0.3)), 1 << max(10, int(np.ceil(np.log2(16 * np.sqrt(v)))) - 1), max(12, round(0.75 * np.log2(v)))


def rounds(words: int) -> int:
    return 2 + int(np.log2(1 + words / ROUND_WORDS) / 2)


def hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the first word of each text (one more entry)."""
    data = _LOWER[data]
    w = find_words(offsets, data)
    return mix(hash_words(data, w.starts, w.ends) + np.uint64(5)).view(np.int64), w.first


@dataclass
class Classes:
    """Classes, input places and shares of the words; ``head`` ascending. Classes from ``tail`` on hold
    the other words, by hash."""

    head: np.ndarray
    head_class: np.ndarray
    head_place: np.ndarray
    head_within: np.ndarray
    tail: int
    mass: np.ndarray  # of each class
    inputs: int
    width: int

    @classmethod
    def layout(cls, head: np.ndarray, n: np.ndarray, total: int, distinct: int) -> Classes:
        """From the most frequent words and their counts, most frequent first; the tail's masses are still UNSEEN."""
        number, inputs, width = sizes(distinct)
        tails = min(number - 1, max(1, round(number * (total - n.sum()) / max(1, total))))
        tail = number - tails
        upto = np.cumsum(n) / max(1, n.sum())
        of = np.minimum((upto - n / max(1, n.sum()) / 2) * tail, tail - 1).astype(np.int64)
        mass = np.concatenate([np.bincount(of, n, tail), np.full(tails, UNSEEN)])
        by = np.argsort(head)
        own = inputs // 2  # frequent words have an input place of their own
        rank = np.arange(len(head))
        place = np.where(rank < own - 1, rank + 1, own + head % (inputs - own))
        return cls(head[by], of[by], place[by], np.log(n / mass[of])[by], tail, mass, inputs, width)

    @property
    def tails(self) -> int:
        return len(self.mass) - self.tail

    def find(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of each word in the head, whether it is there)"""
        if not len(self.head):
            return np.zeros(len(word), np.int64), np.zeros(len(word), bool)
        at = np.minimum(np.searchsorted(self.head, word), len(self.head) - 1)
        return at, self.head[at] == word

    def place_and_class(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Input place, class, log share of the class (beyond the head: less the log count), in the head."""
        at, hit = self.find(word)
        own = self.inputs // 2
        place, of = own + word % (self.inputs - own), self.tail + word % self.tails
        within = -np.log(self.mass[of])
        place[hit], of[hit], within[hit] = self.head_place[at[hit]], self.head_class[at[hit]], self.head_within[at[hit]]
        return place, of, within, hit


@dataclass
class Vocabulary:
    counts: DataFrame  # word, n: every distinct word
    classes: Classes


def contexts(place: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Input places around every word; 0 is outside the text."""
    n = len(place)
    count = np.diff(first)
    lo, hi = np.repeat(first[:-1], count), np.repeat(first[1:], count)
    at = np.arange(n)
    out = np.zeros((n, len(_OFFSETS)), np.int64)
    for k, o in enumerate(_OFFSETS):
        inside = (at + o >= lo) & (at + o < hi)
        out[inside, k] = place[at[inside] + o]
    return out


@dataclass
class Network:
    embed: np.ndarray  # inputs, width
    offset: np.ndarray  # offsets, width
    hidden: np.ndarray  # width
    out: np.ndarray  # width, classes
    bias: np.ndarray  # classes

    @classmethod
    def start(cls, classes: Classes, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        f = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        share, width = classes.mass / classes.mass.sum(), classes.width
        return cls(f(classes.inputs, width), 1 + f(len(_OFFSETS), width), f(width) * 0, f(width, len(share)),
                   np.log(np.maximum(share, 1e-9)).astype(np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.offset, self.hidden, self.out, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parameters()])

    def like(self, flat: np.ndarray) -> Network:
        """A network of this shape with the given parameters."""
        cut = np.split(flat.astype(np.float32), np.cumsum([x.size for x in self.parameters()])[:-1])
        return Network(*(c.reshape(x.shape).copy() for c, x in zip(cut, self.parameters())))

    def layers(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(embeddings of the context, hidden layer, output below 0)"""
        e = self.embed.take(context, axis=0)
        total = e[:, 0] * self.offset[0]
        for k in range(1, context.shape[1]):
            total += e[:, k] * self.offset[k]
        total += self.hidden
        h = np.tanh(total, out=total)
        z = h @ self.out
        z += self.bias
        z -= z.max(axis=1, keepdims=True)
        return e, h, z

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hidden layer, log-probabilities of the classes)"""
        _, h, z = self.layers(context)
        return h, z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def of_class(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of one class for each context."""
        _, _, z = self.layers(context)
        own = z[np.arange(len(z)), target]
        return own - np.log(np.exp(z, out=z).sum(axis=1))

    def train(self, context: np.ndarray, target: np.ndarray, seed: int) -> None:
        """One pass of gradient steps in random order."""
        order = np.random.default_rng(seed).permutation(len(target))
        width = np.arange(self.embed.shape[1])
        for at in range(0, len(order), BATCH):
            i = order[at:at + BATCH]
            c = context[i]
            e, h, g = self.layers(c)
            np.exp(g, out=g)
            g /= g.sum(axis=1, keepdims=True)
            g[np.arange(len(i)), target[i]] -= 1
            g *= RATE / BATCH  # a last, small batch counts less
            back = (g @ self.out.T) * (1 - h * h)
            self.out -= h.T @ g
            self.bias -= g.sum(axis=0)
            self.hidden -= back.sum(axis=0)
            # a rare word's few gradients count as much as a batch of them would
            step = (-16 * back)[:, None, :] * self.offset
            for k in range(c.shape[1]):
                self.offset[k] -= (back * e[:, k]).sum(axis=0)
            np.add.at(self.embed.reshape(-1), (c[:, :, None] * len(width) + width).ravel(), step.ravel())


def score_words(net: Network, classes: Classes, word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of every word given both sides, and whether it is in the head; the log count of
    the others is still to be added."""
    place, target, within, hit = classes.place_and_class(word)
    out = np.empty(len(word))
    context = contexts(place, first)
    for at in range(0, len(word), 1024):
        out[at:at + 1024] = net.of_class(context[at:at + 1024], target[at:at + 1024])
    return out + within, hit


def corpus_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) of all documents, written."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for _, _, offsets, data in pieces(b.column(0)):
                word, n = np.unique(hashes(offsets, data)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n.astype(np.int64))], names=["word", "n"])

    some = docs.select(text_col).transform(small_batches).mapInArrow(tidy(batches), "word bigint, n bigint")
    return written(some.groupBy("word").agg(F.sum("n").alias("n")), "words")


def vocabulary(docs: DataFrame, text_col: str = "text") -> Vocabulary:
    counts = corpus_counts(docs, text_col)
    distinct, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    head = counts.orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    word, n = head["word"].to_numpy(), head["n"].to_numpy()
    classes = Classes.layout(word, n.astype(float), total, distinct)
    if distinct > len(word):
        beyond = (F.col("n") < int(n[-1])) | ((F.col("n") == int(n[-1])) & (F.col("word") > int(word[-1])))
        # a row for each class of the tail
        for r in counts.where(beyond).groupBy(F.pmod("word", F.lit(classes.tails)).alias("k")).agg(F.sum("n").alias("n")).collect():
            classes.mass[classes.tail + r["k"]] += r["n"]
    return Vocabulary(counts, classes)


def _copy(sent, number: int):
    """Train a copy on the texts of a partition; its parameters in blocks."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, classes = sent.value
        net, weight = net.like(net.flat()), 0
        for b in it:
            for _, _, offsets, data in pieces(b.column(0)):
                word, first = hashes(offsets, data)
                place, target, _, _ = classes.place_and_class(word)
                net.train(contexts(place, first), target, number + weight)
                weight += len(word)
        if weight:
            flat, shard = net.flat(), TaskContext.get().partitionId()
            parts = [flat[at:at + BLOCK].tobytes() for at in range(0, len(flat), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([shard] * len(parts), pa.int32()),
                                              pa.array([weight] * len(parts), pa.int64()), pa.array(parts, pa.binary())],
                                             names=["block", "shard", "weight", "mean"])
    return batches


def _mean(t: pa.Table) -> pa.Table:
    """The weighted mean of a block's copies."""
    t = t.sort_by("shard").combine_chunks()
    weight = t["weight"].to_pylist()
    total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) * w for x, w in zip(t["mean"], weight)) / sum(weight)
    return pa.table({"block": t["block"].combine_chunks()[:1], "shard": pa.array([t["shard"][0].as_py() >> FAN_BITS], pa.int32()),
                     "weight": pa.array([sum(weight)], pa.int64()), "mean": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Network, Vocabulary]:
    """``id_col`` is not read: a document's round follows from its text."""
    spark, words = docs.sparkSession, vocabulary(docs, text_col)
    net = Network.start(words.classes)
    number = rounds(int(words.classes.mass.sum()))
    kind = "block int, shard int, weight bigint, mean binary"
    for k in range(number):
        sent = spark.sparkContext.broadcast((net, words.classes))
        part = docs.select(text_col).where(F.pmod(F.xxhash64(text_col), F.lit(number)) == k).transform(small_batches)
        copies = part.mapInArrow(tidy(_copy(sent, k)), kind)
        for _ in range(2):
            copies = copies.groupBy("block", F.shiftright("shard", FAN_BITS)).applyInArrow(tidy_group(_mean), kind)
        # the model, which grows with the square root of the distinct words
        blocks = copies.groupBy("block").applyInArrow(tidy_group(_mean), kind).orderBy("block").collect()
        if blocks:
            net = net.like(np.concatenate([np.frombuffer(r["mean"], np.float32) for r in blocks]))
    return net, words


def score(docs: DataFrame, net: Network, words: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, log_prob (sum over its words), mean_log_prob."""
    sent = docs.sparkSession.sparkContext.broadcast((net, words.classes))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, classes = sent.value
        row = TaskContext.get().partitionId() << 33  # rows of the table that is written have a number
        for b in it:
            for lo, hi, offsets, data in pieces(b.column(1)):
                word, first = hashes(offsets, data)
                each, hit = score_words(net, classes, word, first)
                n = np.diff(first)
                doc = np.repeat(np.arange(hi - lo), n)
                rare = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[~hit], minlength=hi - lo))]), pa.int32()), pa.array(word[~hit]))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + hi - lo)), b.column(0)[lo:hi], pa.array(n.astype(np.int64)),
                                                  pa.array(np.bincount(doc, each, hi - lo)), rare], names=["row", "id", "n_words", "log_prob", "rare"])
                row += hi - lo

    kind = docs.schema[id_col].dataType.simpleString()
    scored = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(small_batches)
                     .mapInArrow(tidy(batches), f"row bigint, id {kind}, n_words bigint, log_prob double, rare array<bigint>"), "scored")
    # no word beyond the head is more than one word in HEAD of the corpus, so no key of this join is hot
    rare = (scored.select("row", F.explode("rare").alias("word")).join(words.counts, "word", "left")
            .select("row", F.lit(None).cast(kind).alias("id"), F.lit(0).cast("bigint").alias("n_words"),
                    F.log(F.coalesce(F.col("n").cast("double"), F.lit(UNSEEN))).alias("log_prob")))
    summed = scored.drop("rare").unionByName(rare).groupBy("row").agg(F.max("id").alias("id"), F.sum("n_words").alias("n_words"), F.sum("log_prob").alias("log_prob"))
    return summed.select(F.col("id").alias(id_col), "n_words", "log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias("mean_log_prob"))
