"""File sources: raw JSON batches, enriched NDJSON, training CSV, evolving Parquet, file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.schema import ENRICHED, RAW_BATCH_READ, RAW_ITEM_FIELDS, TRAINING


def unwrap_batches(docs: DataFrame) -> DataFrame:
    """Batch documents -> items in one pass: a wrapped document contributes its ``data`` array,
    a bare-array element is an item itself."""
    item = F.struct(*[F.col(c) for c in RAW_ITEM_FIELDS])
    arr = F.when(F.col("data").isNotNull(), F.col("data")).when(F.col("id").isNotNull(), F.array(item))
    return docs.select(F.explode(arr).alias("it")).select("it.*")


def read_raw_batches(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``multi_line`` for pretty-printed one-document files (the original's format); our writer puts
    one document per line, which is splittable and reads with ``multi_line=False``. Unparseable
    records land in ``_corrupt_record`` (PERMISSIVE) instead of failing the batch."""
    docs = (spark.read.schema(RAW_BATCH_READ).option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    return unwrap_batches(docs)


def corrupt_batches(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(file, record) of the documents that could not be parsed, for a count and a folder aside."""
    lines = spark.read.option("wholetext", multi_line).text(path)
    parsed = F.from_json("value", RAW_BATCH_READ, {"columnNameOfCorruptRecord": "_corrupt_record"})
    return (lines.select(F.col("_metadata.file_path").alias("file"), parsed["_corrupt_record"].alias("record"))
            .filter(F.col("record").isNotNull()))


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENRICHED).json(path)


NULL_TOKEN = "\\N"  # nulls and empty strings stay distinct through a CSV round trip


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV under ``path`` (the original read only the first). Quoted fields may hold commas,
    quotes and newlines."""
    return (spark.read.schema(TRAINING).option("header", True).option("multiLine", True)
            .option("escape", '"').option("quote", '"').option("nullValue", NULL_TOKEN).csv(path))


def read_enriched_table(spark: SparkSession, path: str, since: float | None = None) -> DataFrame:
    """The day-partitioned enriched table; ``since`` (a mark, epoch seconds) becomes both the row
    filter and an explicit partition bound on ``post_date`` (Catalyst cannot derive the day bound
    from the ``created_utc`` predicate by itself)."""
    d = spark.read.parquet(path)
    if since is None:
        return d
    day = F.to_date(F.timestamp_seconds(F.lit(float(since))))
    return d.filter((F.col("post_date") >= day) & (F.col("created_utc") >= F.lit(float(since))))


def read_evolving_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet written by several schema versions: columns are the union, missing ones null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def raw_stream(spark: SparkSession, path: str, multi_line: bool = False, max_files: int | None = None) -> DataFrame:
    """New batch files under ``path``, each processed once (the checkpoint records them)."""
    r = spark.readStream.schema(RAW_BATCH_READ).option("multiLine", multi_line)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return unwrap_batches(r.json(path))

