"""Sinks. Every write replaces its own output path, run folder or (day, run) partition, so a
retried task or a replayed run never duplicates rows and never touches another run's."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur import params as P
from murmur.schema import RAW_ITEM
from murmur.session import batch_bytes
from murmur.sources.files import NULL_TOKEN

#: Bytes of the Arrow batches of items that a task packs into documents.
BATCH_BYTES = 8 << 20


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there such a folder? A store that cannot answer raises."""
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def folder_names(spark: SparkSession, root: str) -> list[str]:
    p, fs = _path(spark, root)
    return [f.getPath().getName() for f in fs.listStatus(p)]


def remove_folders(spark: SparkSession, root: str, key: str, before: int) -> None:
    """Remove the partition folders ``key=n`` of ``root`` with n < ``before``."""
    p, fs = _path(spark, root)
    for f in fs.listStatus(p):
        name = f.getPath().getName()
        if name.startswith(f"{key}=") and int(name.partition("=")[2]) < before:
            fs.delete(f.getPath(), True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder in its store; where there is none, an empty one appears."""
    (old, fs), (new, _) = _path(spark, path), _path(spark, to)
    fs.mkdirs(new.getParent() if fs.exists(old) else new)
    if fs.exists(old) and not fs.rename(old, new):
        raise OSError(f"cannot move {path} to {to}")


def _packed(size: int, count=lambda n: None):
    """mapInArrow body: items (one struct column) -> arrays of ``size`` consecutive items of the task, the
    last one shorter. ``count`` is told their numbers."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(items: pa.Array, offsets: list[int]) -> pa.RecordBatch:
            count(len(offsets) - 1)
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)], names=["data"])
        rest = None
        for b in batches:
            items = b.column(0) if rest is None else pa.concat_arrays([rest, b.column(0)])
            full = len(items) // size * size
            if full:
                yield rows(items[:full], [*range(0, full + 1, size)])
            rest = items[full:]
        if rest is not None and len(rest):
            yield rows(rest, [0, len(rest)])
    return pack


def write_raw_batches(items: DataFrame, path: str, timestamp: str, keywords, batch_size: int = 1000,
                      communities: DataFrame | None = None, run: str | None = None) -> int:
    """Items -> batch documents {metadata, data:[...]} of ``batch_size`` items each, one per line, in a
    folder of the run's own when ``run`` is given (earlier runs stay). Each task packs the items it has,
    its last document may be shorter: whole texts are not shuffled for it, no document grows with the
    data and a hot community is split like any other; files are gzipped, one for each task. Every
    document's metadata is the run's: all its items and the communities it went through. Returns the
    number of documents."""
    spark = items.sparkSession
    names_of = F.array_sort(F.collect_set("subreddit"))  # a dimension: one name per community
    if communities is None:
        n, names = items.agg(F.count(F.lit(1)), names_of).first()
    else:
        n, names = items.count(), communities.agg(names_of).first()[0]
    kinds = {f.name: f.dataType for f in items.schema.fields if not isinstance(f.dataType, T.NullType)}
    cols = [F.col(f.name) if f.name in kinds else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_ITEM.fields]
    written = spark.sparkContext.accumulator(0)  # an Observation would stay in the session, which ML jobs then cannot serialize
    packed = items.select(F.struct(*cols).alias("it"))
    docs = packed.mapInArrow(_packed(batch_size, written.add), T.StructType([T.StructField("data", T.ArrayType(packed.schema["it"].dataType))]))
    meta = F.struct(F.lit(timestamp).alias("timestamp"), F.lit(n).cast("bigint").alias("total_items"),
                    F.array(*[F.lit(x) for x in names]).cast("array<string>").alias("processed_subreddits"),
                    F.array(*[F.lit(k) for k in keywords]).alias("keywords"))
    docs = docs.select(meta.alias("metadata"), "data")
    with batch_bytes(spark, BATCH_BYTES):
        docs.write.mode("overwrite").option("compression", "gzip").json(path if run is None else f"{path}/run={run}")
    return written.value


def stored_mark(spark: SparkSession, path: str, before: str) -> float | None:
    """The newest mark that runs before this one stored under ``path``/run=...; none before the first."""
    if not path_exists(spark, path):
        return None
    marks = spark.read.schema("new_mark double, run string").parquet(path).filter(F.col("run") < before)
    return marks.agg(F.max("new_mark")).first()[0]


def write_ndjson(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)


def write_training_csv(df: DataFrame, path: str) -> None:
    """Header, quoted where needed with RFC 4180 doubling of quotes; an empty result is an error,
    as in the original."""
    if df.isEmpty():
        raise ValueError(P.NO_TRAINING_DATA)
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("quote", '"')
     .option("emptyValue", '""').option("nullValue", NULL_TOKEN).csv(path))


def write_snapshots(before: DataFrame, after: DataFrame, path: str, stamp: str) -> dict[str, str]:
    """Backup of the input and the final labeled table, each a versioned path written once. (The progress
    of a run that may be resumed: ``sources.runs``.)"""
    out = {"backup": f"{path}/backup_{stamp}", "final": f"{path}/ai_labeled_{stamp}"}
    write_training_csv(before, out["backup"])
    write_training_csv(after, out["final"])
    return out


def write_evolving(df: DataFrame, path: str, version: str) -> None:
    """Append one schema version as its own partition directory."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def write_enriched_table(df: DataFrame, path: str, run: str) -> None:
    """The rows of one run, added to the enriched table: Parquet partitioned by UTC day and run. Only
    the run's own partitions are replaced (a replay writes them again), so the table keeps its
    history; readers prune whole days. The rebalance lets Spark split a large day over tasks and
    merge small ones; rows sorted by time inside each file keep the row-group min/max tight."""
    from murmur.functions.text import epoch_to_day
    d = df if "post_date" in df.columns else df.withColumn("post_date", epoch_to_day("created_utc"))
    (d.withColumn("run", F.lit(run)).hint("rebalance", "post_date").sortWithinPartitions("post_date", "created_utc")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy("post_date", "run").parquet(path))
