"""Driver parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from murmur.session import ensure_conf

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Parquet, so column pruning and filter pushdown reach the scan."""
    ensure_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
