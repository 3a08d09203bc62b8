"""The corpus pipeline: stages over ``documents``, each one of the operators of ``murmur.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes it as Parquet
under ``spark.checkpoint.dir`` and hands the reread rows to the next one.

Cases: a null or empty text fails the quality rules (it has fewer words than they ask for); rows of one
id stay when their texts do not link, and rows with a null id are never taken for near-duplicates; a
text that is wholly a repeated passage stays as an empty row, which the mix takes no words of; a very
long text is one row throughout; other columns, whatever their names, are carried to the mix; an empty
table gives an empty result.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from murmur.llm import mixing, quality, simhash, substrings  # noqa: E402
from murmur.llm.queries import bpe_digests  # noqa: E402
from murmur.llm.registry import table  # noqa: E402
from murmur.llm.store import written  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier in the corpus go from the texts; the other texts stay as they are."""
    return substrings.without_repeats(docs, length_col="n_chars")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts, a row for each row of the mix."""
    return bpe_digests(docs)


STAGES = [("quality rules", quality_rules), ("simhash near-dedup", simhash_near_dedup), ("substring dedup", substring_dedup),
          ("source mixing", source_mixing), ("byte-level bpe", byte_bpe)]

#: XXH64 fingerprints and BPE ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_").replace("-", "_"))
    return docs
