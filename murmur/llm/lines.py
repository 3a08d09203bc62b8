"""Line dedup by normalised line hashes; DataFrame operations only.

Lines are exploded, normalised (blanks at both ends go, A-Z in lower case) and hashed to 128 bits.
A first count of rows per hash leaves the few hashes that can be in enough documents; only their
lines are joined, counted by distinct documents and dropped. Of a text that loses lines the kept ones
are the stretches between the dropped positions, so reassembly is linear in its lines.

The hashes (some 40 bytes a line) are written once, as three later steps read them. Counts are summed before each shuffle and joins exchange both sides, so that a line which stands in a
third of all documents is split; nothing is gathered but the dropped positions of a single text.

Cases: a null or empty text is one empty line; rows of one id are one document, rows without an id are
one document, below all others; a line that repeats within a document is dropped or kept at all its
places; equal rows give equal results; a very long text is worked on whole; an empty table gives an
empty result; other columns are not read by :func:`line_dedup` and passed on by :func:`without_repeats`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.store import written

MIN_CHARS, MIN_DOCS = 40, 5
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def bare_line(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def line_key(bare: Column) -> Column:
    """A bare line with A-Z (no other letters) in lower case, and so of the same length."""
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hashed(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, of, pos, h1, h2) of the lines that are long enough; ``of`` tells texts of one id apart."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("of"), F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"))
    # one element: an array's explosion keeps the bare line from being worked out again for the filter and each hash
    rows = rows.where(F.char_length("line") >= min_chars).select("id", "of", "pos", F.explode(F.array(bare_line(F.col("line")))).alias("bare"))
    rows = rows.where(F.char_length("bare") >= min_chars).select("id", "of", "pos", F.explode(F.array(line_key(F.col("bare")))).alias("key"))
    return rows.select("id", "of", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(min_chars), "key").alias("h2"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, of, dropped: sorted positions) of the texts that lose lines."""
    lines = written(_hashed(docs, id_col, text_col, min_chars), "lines")
    # at least as many rows as documents: the others need no look at their documents
    often = lines.groupBy(*HASH).agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select(*HASH)
    found = written(lines.join(written(often, "often"), HASH), "found")
    common = (found.select(*HASH, "id").distinct().groupBy(*HASH).agg(F.count("*").alias("documents"), F.max("id").alias("last"))
              .where(F.col("documents") >= min_docs).select(*HASH, "last"))
    gone = found.join(written(common, "common"), HASH).where(F.col("last").isNotNull() & (F.col("id").isNull() | (F.col("id") != F.col("last"))))
    return gone.groupBy("id", "of").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def _kept(lines: Column, dropped: Column) -> Column:
    """The lines outside ``dropped``: the stretches between its positions."""
    ends = F.concat(dropped, F.array(F.size(lines)))
    begins = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
    return F.flatten(F.zip_with(begins, ends, lambda b, e: F.slice(lines, b + 1, e - b)))


def _rejoined(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """(row: the columns of ``docs``; n_lines, n_dropped, kept)"""
    gone = dropped_lines(docs, id_col, text_col, min_chars, min_docs)
    rows = docs.select(F.struct("*").alias("row")).withColumn("text", F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")))
    rows = rows.withColumn("of", F.xxhash64(F.col(f"row.`{text_col}`")))
    out = rows.join(gone, F.col(f"row.`{id_col}`").eqNullSafe(gone["id"]) & (rows["of"] == gone["of"]), "left")
    n_dropped = F.coalesce(F.size("dropped"), F.lit(0)).cast("long")
    n_lines = (F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("long")
    # the one-element transform holds the split text, so that it is split once
    kept = F.transform(F.array(split_lines(F.col("text"))), lambda a: F.array_join(_kept(a, F.col("dropped")), "\n"))[0]
    return out.select("row", n_lines.alias("n_lines"), F.when(F.size("dropped") > 0, n_dropped).otherwise(0).cast("long").alias("n_dropped"),
                      F.when(F.size("dropped") > 0, kept).otherwise(F.col("text")).alias("kept"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: id, n_lines, n_dropped, kept (text)."""
    out = _rejoined(docs.select(id_col, text_col), id_col, text_col, min_chars, min_docs)
    return out.select(F.col(f"row.`{id_col}`").alias(id_col), "n_lines", "n_dropped", "kept")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``docs`` with the kept lines as text; texts that lose nothing stay as they are, nulls too."""
    out = _rejoined(docs, id_col, text_col, min_chars, min_docs)
    columns = [F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col(f"row.`{c}`")).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
               for c in docs.columns]
    return out.select(*columns)
