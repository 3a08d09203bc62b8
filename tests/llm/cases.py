"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing names."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

CLASHING = ["row", "cell", "pack", "hash", "key", "size", "print", "kept", "n_words", "root", "salt", "times", "label"]
SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                     StructField("source", StringType()), StructField("n_chars", LongType()), *(StructField(c, StringType()) for c in CLASHING)])


def rows(texts_by_id):
    return [(i, t, None, s, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t, s in texts_by_id]


def odd(spark):
    prose = " ".join(f"word{k * 7 % 101}" for k in range(60))
    data = [(1, prose, "a"), (2, prose, "a"), (2, prose, "a"), (3, None, "b"), (4, "", None), (5, " \n\t ", None), (6, "one", "b"),
            (None, prose + " end", "b"), (None, None, None), (7, "x " * 30_000, "a"), (8, "y" * 70_000, "é"), (9, "é ü\n" * 40, "a"),
            (10, prose.upper(), "A"), (11, "a b c", "a"), (-5, "MIT License. mit license", "b")]
    return spark.createDataFrame(rows(data), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
