"""Mixing sources to target weights by hash-threshold histograms; DataFrame operations only.

Every document has a 48-bit hash of its id. Sizes are summed by (source, leading 12 bits); the
bucket in which a source's budget ends is refined by its next 12 bits, and so on, so that a source
takes the documents with a hash up to one threshold: no sort of the documents, one filter. Budgets
above a source's size take whole copies first; thresholds of a smaller budget are below those of a
larger one (nested).

Cases: a null text has size 0 and a null source is a source, the last; documents with equal ids
have equal hashes and are taken or left together; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.store import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Share of all sizes that the mix holds, and how often a source may be repeated.
MIX_SHARE, MAX_EPOCHS = 1.5, 2.0
HASH_BITS, LEVEL_BITS = 48, 12
#: A source's rows meet its threshold in this many places.
SALTS = 64
#: Ranges in which sources are numbered.
RANGES = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash48(key: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """Never null; in the order of the sources by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``number``: their rank by ``key`` from 0, without one task that sorts them all."""
    parts = written(rows.repartitionByRange(RANGES, key).withColumn("part", F.spark_partition_id()), "ranges")
    # at most RANGES rows
    before = (parts.groupBy("part").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n"))
    return (parts.join(F.broadcast(before), "part")
            .withColumn("number", F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(key)) - 1)
            .drop("part", "before"))


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, epochs: float) -> DataFrame:
    """``sources`` (key, source_size) with target: min(epochs * size, level * weight), the level such
    that all targets together are ``share`` of all sizes. Each round reshares what sources at their
    bound leave over; only three sums reach the driver."""
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    rows = written(numbered(sources, "key").withColumn("weight", pick).withColumn("bound", F.lit(epochs) * F.col("source_size")), "sources")
    level, full = 0.0, -1
    while True:
        at_bound = F.col("bound") <= F.lit(level) * F.col("weight")
        total, held, weight, n = rows.agg(
            F.sum("source_size"), F.sum(F.when(at_bound, F.col("bound"))), F.sum(F.when(~at_bound, F.col("weight"))),
            F.count(F.when(at_bound, 1))).first()
        if n == full or not weight:
            break
        level, full = (share * total - (held or 0.0)) / weight, n
    return rows.withColumn("target", F.least("bound", F.lit(level) * F.col("weight"))).drop("bound", "number")


def thresholds(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with copies (whole ones) and threshold: documents with a hash up to it are taken
    once more. ``sized``: key, size, hash."""
    n = F.col("source_size")
    whole = F.when(n > 0, F.floor(F.col("target") / n)).otherwise(0).cast("long")
    budgets = sources.withColumn("copies", whole).withColumn("rest", F.col("target") - F.col("copies") * n)
    # prefix: the leading bits of the bucket being refined; below: the size taken under it
    open_ = budgets.select("key", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    rows, ended = sized.where("size > 0").select("key", "size", "hash"), []
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - level * LEVEL_BITS
        bucket = F.shiftright("hash", shift)
        if level > 1:
            parent = F.shiftright("hash", shift + LEVEL_BITS)
            rows = rows.withColumn("prefix", parent).join(open_.select("key", "prefix"), ["key", "prefix"]).drop("prefix")
        histogram = rows.groupBy("key", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
        upto = Window.partitionBy("key").orderBy("bucket")
        running = (histogram.join(open_.select("key", "rest", "below"), "key")
                   .withColumn("upto", F.col("below") + F.sum("size").over(upto)))
        end = F.min(F.struct("bucket", "upto", "size", "rest"))
        crossing = running.where("upto > rest").groupBy("key").agg(end.alias("x")).select(
            "key", F.col("x.bucket").alias("prefix"), (F.col("x.upto") - F.col("x.size")).alias("below"), F.col("x.rest").alias("rest"),
            F.col("x.upto").alias("upto"))
        open_ = written(crossing, f"level{level}")
    nearer = F.col("upto") - F.col("rest") < F.col("rest") - F.col("below")
    last = open_.select("key", F.when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("threshold"))
    return written(budgets.drop("rest").join(last, "key", "left").withColumn(
        "threshold", F.coalesce("threshold", F.lit(-1).cast("long"))), "thresholds")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple[int, ...] = WEIGHTS, share: float = MIX_SHARE, epochs: float = MAX_EPOCHS) -> tuple[DataFrame, DataFrame]:
    """(documents: id, source, size, hash, key; sources: key, source_size, target, copies, threshold)"""
    sized = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                                hash48(F.col(id_col)).alias("hash"), source_key(F.col(source_col)).alias("key")), "sizes")
    sources = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    return sized, thresholds(sized, targets(sources, weights, share, epochs))


def take(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` (with key and hash) with the columns of their source and ``times``, how often each is
    taken. A source's row stands in SALTS places, so that a large source spreads over as many."""
    spread = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("salt", (F.col("hash") % SALTS).cast("int")).join(spread, ["key", "salt"])
            .withColumn("times", F.col("copies") + (F.col("hash") <= F.col("threshold")).cast("long")).drop("salt"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target, taken."""
    sized, sources = plan(docs, id_col, text_col, source_col)
    return take(sized, sources).select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of the mix with the columns of ``docs``, each as often as it is taken."""
    _, sources = plan(docs, id_col, text_col, source_col)
    columns = [F.col(f"row.{c}").alias(c) for c in docs.columns]
    rows = docs.select(F.struct("*").alias("row"), hash48(F.col(id_col)).alias("hash"), source_key(F.col(source_col)).alias("key"))
    once_each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return take(rows, sources).where("times > 0").select("row", once_each.alias("nth")).select(*columns)
