"""Groups in bounded cells, and connected components, for the similarity joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.store import drop, written


def bounded_cells(rows: DataFrame, group: str, member: str, limit: int) -> DataFrame:
    """``rows`` with ``cell`` (long): any two members of a group meet in at least one cell, and a cell
    has about 2 * limit rows at most. A group of more than ``limit`` rows is dealt into parts, and
    every two parts make a cell; whole results, whatever the size of a group. Members of one part meet
    in several cells; ``home`` is true in one of them (members of two parts meet in one cell only, and
    ``part`` tells parts apart)."""
    large = written(rows.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n") > limit), "large")
    parts = F.coalesce(F.ceil(F.col("n") / limit), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit(1)), F.col("parts")).cast("int")
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: q != F.col("own")))
    dealt = rows.join(large, group, "left").withColumn("parts", parts).withColumn("own", own).withColumn("other", F.explode(others))
    return (dealt.withColumn("cell", F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other")))
            .withColumn("home", F.col("other") == F.when((F.col("own") == 0) & (F.col("parts") > 1), 1).otherwise(0))
            .withColumnRenamed("own", "part").drop("n", "parts", "other"))


def whole_cells(batches: Iterator[pa.RecordBatch], rows: int = 1 << 15) -> Iterator[pa.Table]:
    """Batches sorted by ``cell``, regrouped so that no cell is cut."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n >= rows:
            t = pa.Table.from_batches(held)
            cell = t["cell"].to_numpy()
            cut = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if cell[0] != cell[-1] else 0
            if cut:
                yield t.slice(0, cut)
                held = t.slice(cut).combine_chunks().to_batches()
                n = t.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component, from links a[k] - b[k]."""
    at = np.arange(n)
    while len(a):
        low, high = np.minimum(at[a], at[b]), np.maximum(at[a], at[b])
        open_ = low != high
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        np.minimum.at(at, high[open_], low[open_])
        while True:
            up = at[at]
            if (up == at).all():
                break
            at = up
    return at


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the nodes that ``links`` (a, b: long) name; one root per component.

    Rounds of contraction: every node goes to its neighbour of the smallest hash, if smaller than its
    own, and links are renamed; a few rounds empty the links. A round's tables are written, so a node
    with very many links is split when they are joined, and only a count reaches the driver."""
    links = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = written(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("root", F.col("node")), "nodes")
    number = 0
    while not links.isEmpty():
        number += 1
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(number)).alias("h"), F.col(c).alias("node"))  # noqa: E731, B023
        both = links.select("a", "b").union(links.select("b", "a"))
        step = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(F.col("a").alias("root"), F.least("m", rank("a")).getField("node").alias("to"))
        step = written(step, "step")
        next_ = (links.join(step.select(F.col("root").alias("a"), F.col("to").alias("x")), "a")
                 .join(step.select(F.col("root").alias("b"), F.col("to").alias("y")), "b").where("x <> y")
                 .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        moved = written(found.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "nodes")
        next_ = written(next_, "links")
        for old in (links, found, step):
            drop(old)
        links, found = next_, moved
    return found
