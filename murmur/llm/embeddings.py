"""Embedding near-dedup by a pivot-permutation index.

Of a bounded sample of the vectors, pivots are those that are more than two link angles apart: a dense
cluster then has one pivot, and not its members' noise but the cluster's place orders the others. Every vector is described by its NEAREST pivots in order
of cosine, and stands in the inverted list of every two of them: two vectors that meet in a list
share at least two pivots. Each pair is counted in the list of its two smallest shared pivots, once,
after its cosine is verified in double precision. Equal vectors are one node with a number of copies.

The number of pivots is the power of two at or above the root of the number of distinct vectors,
within 32 and MAX_PIVOTS: lists keep their length as the table grows, up to there; longer lists are
split into bounded cells, so no list is cut. Vectors of each length have pivots and lists of their own. Measured recall of links at cosine 0.95: README.

Cases: a vector that is null, empty, zero, or holds null or non-finite components links with nothing;
vectors of different lengths do not link (each length is a run of its own over its rows); rows with equal ids are vectors of their own;
a component's id is its smallest id (null if none), and a null id is never kept; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.graph import bounded_cells, components, roots, whole_cells
from murmur.llm.store import small_batches, tidy, written

COSINE = 0.95
#: Pivots that describe a vector.
NEAREST = 6
MAX_PIVOTS = 4096
#: Sampled vectors for each wanted pivot.
SAMPLE = 8
#: Vectors of one list that meet in one task.
CELL = 512
#: Cells of more rows are compared by blocks, smaller ones side by side.
SMALL = 24

_NODE = "node bigint, copies bigint, vector binary, pivots binary, lists array<bigint>"


def unit(x: np.ndarray) -> np.ndarray:
    # scaled first: squares of very large or small components leave the range of doubles
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def spread(sample: np.ndarray, wanted: int, cosine: float) -> np.ndarray:
    """At most ``wanted`` of the sample's vectors, in its order, no two within twice the link angle."""
    most, chosen = 2 * cosine * cosine - 1, np.empty((0, sample.shape[1]))
    for lo in range(0, len(sample), 256):
        block = sample[lo:lo + 256]
        for k in np.flatnonzero((block @ chosen.T).max(axis=1, initial=-2.0) <= most):
            if len(chosen) < wanted and (chosen @ block[k]).max(initial=-2.0) <= most:
                chosen = np.concatenate([chosen, block[k:k + 1]])
    return chosen


def permutations(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """Indices of the nearest pivots of each vector, the nearest first; of equals the smaller index."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :nearest].astype(np.int16)


def _describe(pivots: np.ndarray, dim: int, nearest: int):
    k = min(nearest, len(pivots))
    two = list(combinations(range(k), 2)) or [(0, 0)]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for lo in range(0, b.num_rows, 2048):
                c = b.slice(lo, 2048)
                x = unit(_matrix(c.column(2), dim))
                near = np.sort(permutations(x, pivots, k), axis=1)
                lists = np.stack([near[:, i].astype(np.int64) * MAX_PIVOTS + near[:, j] for i, j in two], axis=1)
                yield pa.RecordBatch.from_arrays([
                    c.column(0), c.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in near], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, lists.size + 1, len(two), dtype=np.int32), pa.array(lists.ravel()))],
                    names=["node", "copies", "vector", "pivots", "lists"])
    return batches


class Cells:
    """Verified links within the cells of one table: (row, row) of pairs that this cell counts."""

    def __init__(self, t: pa.Table, dim: int, least: float):
        self.least = least
        self.cell, self.list_ = t["cell"].to_numpy(), t["list"].to_numpy()
        self.part, self.home = t["part"].to_numpy(), t["home"].to_numpy()
        self.x = np.frombuffer(b"".join(t["vector"].to_pylist()), np.float64).reshape(-1, dim)
        near = np.frombuffer(b"".join(t["pivots"].to_pylist()), np.int16)
        self.near = near.reshape(t.num_rows, -1)

    def counted(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Is this the one list and cell for the pair? The list names its two smallest shared pivots."""
        met = (self.part[a] != self.part[b]) | self.home[a]
        a, b, out = a[met], b[met], np.zeros(len(a), bool)
        low, high = self.list_[a] // MAX_PIVOTS, self.list_[a] % MAX_PIVOTS
        shared = (self.near[a][:, :, None] == self.near[b][:, None, :]).any(axis=2)
        place = np.cumsum(shared, axis=1)
        rows = np.arange(len(a))
        first = self.near[a][rows, np.argmax(shared, axis=1)]
        second = self.near[a][rows, np.argmax(place >= min(2, self.near.shape[1]), axis=1)]
        out[np.flatnonzero(met)] = (first == low) & (second == high)
        return out

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n = len(self.cell)
        edge = np.flatnonzero(np.concatenate([[True], self.cell[1:] != self.cell[:-1], [True]]))
        size = np.diff(edge)
        rest = np.repeat(size, size) - (np.arange(n) - np.repeat(edge[:-1], size))
        small = np.repeat(size <= SMALL, size)
        for d in range(1, SMALL):
            i = np.flatnonzero(small & (rest > d))
            i = i[np.einsum("ij,ij->i", self.x[i], self.x[i + d]) >= self.least]
            yield i, i + d
        for lo, m in zip(edge[:-1][size > SMALL].tolist(), size[size > SMALL].tolist()):
            for at in range(lo, lo + m, 256):
                rows = self.x[at:min(at + 256, lo + m)]
                a, b = np.nonzero(rows @ self.x[at:lo + m].T >= self.least)
                keep = a < b
                yield a[keep] + at, b[keep] + at


def _verify(dim: int, least: float):
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_cells(it, 1 << 13):
            cells = Cells(t, dim, least)
            n, copies, node = t.num_rows, t["copies"].to_numpy(), t["node"].to_numpy()
            links, at = np.zeros(n, np.int64), np.arange(n)
            for a, b in cells.pairs():
                for k in range(0, len(a), 1 << 16):
                    p, q = a[k:k + (1 << 16)], b[k:k + (1 << 16)]
                    counted = cells.counted(p, q)
                    p, q = p[counted], q[counted]
                    np.add.at(links, p, copies[q])
                    np.add.at(links, q, copies[p])
                    if len(p):  # of the links, those that join what is apart so far
                        p, q = at[p], at[q]
                        apart = p != q
                        if apart.any():
                            at = roots(n, np.concatenate([np.arange(n), p[apart]]), np.concatenate([at, q[apart]]))
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[at[some]]), pa.array(links[some])], names=["a", "b", "n"])
    return batches


def _links(nodes: DataFrame, dim: int, cosine: float, nearest: int, n_pivots: int | None) -> DataFrame:
    """(a, b, n): for nodes that link, another one of their component in the same cell, and links counted there."""
    n = nodes.count()
    wanted = n_pivots or min(MAX_PIVOTS, max(32, 1 << (int(n - 1).bit_length() + 1) // 2))
    # at most SAMPLE * MAX_PIVOTS vectors
    picked = nodes.orderBy(F.xxhash64("vector"), "node").limit(SAMPLE * wanted).select("vector").toArrow()
    pivots = spread(unit(_matrix(picked["vector"], dim)), wanted, cosine)
    described = written(nodes.select("node", "copies", "vector").transform(small_batches).mapInArrow(tidy(_describe(pivots, dim, nearest)), _NODE), "described")
    listed = described.select("node", "copies", "vector", "pivots", F.explode("lists").alias("list"))
    cells = bounded_cells(listed, "list", "node", CELL).select("cell", "list", "part", "home", "node", "copies", "vector", "pivots")
    return cells.repartition("cell").sortWithinPartitions("cell").transform(small_batches).mapInArrow(tidy(_verify(dim, cosine)), "a bigint, b bigint, n bigint")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                    nearest: int = NEAREST, n_pivots: int | None = None) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    sound = F.coalesce((F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))
    nodes = written(rows.where(sound).groupBy("vector").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
                    .withColumn("node", F.monotonically_increasing_id()), "nodes")
    dims = sorted(r[0] for r in nodes.select(F.size("vector")).distinct().collect())
    parts = [_links(nodes.where(F.size("vector") == dim), dim, cosine, nearest, n_pivots) for dim in dims]
    found = written(reduce(DataFrame.union, parts, vectors.sparkSession.createDataFrame([], "a bigint, b bigint, n bigint")), "found")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = components(found.select("a", "b"))
    rooted = written(nodes.select("node", "copies", "least", "vector").join(counts, "node", "left").join(groups, "node", "left")
                     .withColumn("root", F.coalesce("root", "node")), "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    label = written(rooted.join(least, "root").select("vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "labels")
    # a vector that links with nothing has a key of its own
    keyed = rows.withColumn("key", F.when(sound, v)).drop("vector")
    alone = keyed.where("key IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = keyed.where("key IS NOT NULL").join(label.withColumnRenamed("vector", "key"), "key").select("id", "n_links", "component_id")
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                            F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
