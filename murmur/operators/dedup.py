"""Duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from murmur.operators.joins import dedup_ids  # noqa: F401  (left anti join on id)


def dedup_content(df: DataFrame, key: str = "content_hash") -> DataFrame:
    """Keep the earliest row per content hash (id breaks ties). ``row_number() = 1`` plans as a
    WindowGroupLimit that also runs before the shuffle, so a hash shared by a third of all rows
    ships one row per map task, not the whole group."""
    w = W.partitionBy(key).orderBy(F.col("created_utc"), F.col("id"))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# ------------------------------------------------------------------ ids of earlier runs as bits

#: An id is four bits of one 64-bit word; words are dealt to segments. 256 x 4,096 words are 8 MB, whatever
#: the number of ids: past some ten million ids more of them reach the exact join, none is judged by bits alone.
SEGMENTS, WORDS = 256, 1 << 12


def _place(id_col: str, words: int) -> tuple[Column, Column, Column]:
    """(segment, word, mask) of an id."""
    h, g = F.xxhash64(F.col(id_col)), F.xxhash64(F.col(id_col), F.lit("bits"))
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(g, 6 * k), F.lit(64)).cast("int")) for k in range(4)]
    mask = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])
    return F.pmod(h, F.lit(SEGMENTS)).cast("int"), F.pmod(F.shiftright(h, 8), F.lit(words)).cast("int"), mask


def id_bits(ids: DataFrame, id_col: str = "id", words: int = WORDS) -> DataFrame:
    """(segment, word, bits) of a run's ids: partial ORs before the one small exchange. Runs are merged by
    OR, so each run adds rows of its own and rewrites nothing."""
    segment, word, mask = _place(id_col, words)
    return (ids.where(F.col(id_col).isNotNull()).select(segment.alias("segment"), word.alias("word"), mask.alias("mask"))
            .groupBy("segment", "word").agg(F.bit_or("mask").alias("bits")))


def write_id_bits(ids: DataFrame, path: str, run: str, id_col: str = "id") -> None:
    """Add a run's bits to the table at ``path``; a repeated run replaces its own."""
    id_bits(ids, id_col).withColumn("run", F.lit(run)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def may_hold(df: DataFrame, bits: DataFrame, id_col: str = "id", words: int = WORDS) -> DataFrame:
    """``df`` with ``_maybe``: false only where no run of ``bits`` held the id. The segments are broadcast:
    SEGMENTS x ``words`` x 8 bytes by construction."""
    spark = df.sparkSession
    every = spark.range(SEGMENTS * words).select((F.col("id") % SEGMENTS).cast("int").alias("segment"),
                                                 F.floor(F.col("id") / SEGMENTS).cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    merged = bits.select("segment", "word", "bits").unionByName(every).groupBy("segment", "word").agg(F.bit_or("bits").alias("bits"))
    dense = merged.groupBy(F.col("segment").alias("_segment")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("_words"))
    segment, word, mask = _place(id_col, words)
    here = F.get(F.col("_words"), word).bitwiseAND(mask) == mask
    return (df.join(F.broadcast(dense), F.when(F.col(id_col).isNotNull(), segment) == F.col("_segment"), "left")
            .withColumn("_maybe", F.coalesce(here, F.lit(False))).drop("_segment", "_words"))


def dedup_ids_by_bits(new_items: DataFrame, seen_ids: DataFrame, bits: DataFrame, id_col: str = "id", words: int = WORDS) -> DataFrame:
    """:func:`dedup_ids` for a long history: the rows of ``dedup_ids(new_items, seen_ids)``, but only new ids
    that ``bits`` (of all of ``seen_ids``) may hold, and only seen ids that those may hold, are exchanged
    and compared. ``new_items`` is read three times: pass a stored table. Null ids are kept."""
    marked = may_hold(new_items, bits, id_col, words)
    possible = marked.where("_maybe").drop("_maybe")
    asked = id_bits(possible, id_col, words)
    seen = may_hold(seen_ids.select(id_col), asked, id_col, words).where("_maybe").select(id_col)
    return marked.where(~F.col("_maybe")).drop("_maybe").unionByName(possible.join(seen, id_col, "left_anti"))
