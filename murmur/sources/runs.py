"""Batch jobs that are resumed by hand or by a scheduler after the driver itself was lost: rows are dealt
to numbered slices, and a log tells which slices are done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.operators import labeling as L
from murmur.sources.sinks import path_exists

SLICES = 64


def deal(rows: DataFrame, path: str, n_slices: int, key: str = "id") -> int:
    """Deal ``rows`` to slices by a hash of their id, once: ``path``/input, with the number of slices in
    ``path``/plan written after it. A restart finds the plan and deals nothing; without a plan the
    input is dealt again, as it may be cut short."""
    spark = rows.sparkSession
    if not path_exists(spark, f"{path}/plan"):
        dealt = rows.withColumn("slice", F.pmod(F.xxhash64(key), F.lit(n_slices)).cast("int"))
        dealt.write.mode("overwrite").partitionBy("slice").parquet(f"{path}/input")
        spark.range(1).select(F.lit(n_slices).alias("n_slices")).write.parquet(f"{path}/plan")
    return spark.read.schema("n_slices int").parquet(f"{path}/plan").first()[0]


def open_slices(spark: SparkSession, path: str, n_slices: int) -> list[int]:
    """The slices that no commit names; at most ``n_slices`` numbers reach the driver."""
    done = set()
    if path_exists(spark, f"{path}/commits"):
        done = {r[0] for r in spark.read.schema("n_rows bigint, slice int").parquet(f"{path}/commits").select("slice").collect()}
    return [k for k in range(n_slices) if k not in done]


def run_slices(rows: DataFrame, path: str, work, n_slices: int = SLICES, at_most: int | None = None, key: str = "id") -> DataFrame:
    """``work`` (DataFrame -> DataFrame) over every slice of ``rows``, each written to its own folder and
    committed after the write. A run that ended early is resumed by the same call: committed slices
    are not worked on again, a slice that was being written is written anew, so every row is worked
    on and kept once. ``at_most`` ends the call after so many slices. Returns the committed rows."""
    spark = rows.sparkSession
    n_slices = deal(rows, path, n_slices, key)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    for k in open_slices(spark, path, n_slices)[:at_most]:
        there = path_exists(spark, f"{path}/input/slice={k}")  # a slice without rows has no folder
        part = spark.read.schema(kinds).parquet(f"{path}/input/slice={k}") if there else spark.createDataFrame([], rows.schema)
        out = work(part)
        out.write.mode("overwrite").parquet(f"{path}/output/slice={k}")
        n = spark.read.schema(out.schema).parquet(f"{path}/output/slice={k}").count()
        spark.range(1).select(F.lit(n).cast("bigint").alias("n_rows")).write.mode("overwrite").parquet(f"{path}/commits/slice={k}")
    schema = work(spark.createDataFrame([], rows.schema)).schema
    done = set(range(n_slices)) - set(open_slices(spark, path, n_slices))
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/output/slice={k}" for k in sorted(done)])


def label_slices(table_df: DataFrame, path: str, run_timestamp: str, n_slices: int = SLICES, cues: tuple = L.RULE_CUES,
                 cut: int | None = None, at_most: int | None = None) -> DataFrame:
    """The labeling run as slices: the labeled table so far, with the original's progress copies as the
    committed slices under ``path``."""
    return run_slices(table_df, path, lambda d: L.lbl_ai_label(d, run_timestamp, cues, cut), n_slices, at_most)
