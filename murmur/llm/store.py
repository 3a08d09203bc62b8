"""Intermediate tables in the shared folder of ``spark.checkpoint.dir``.

A written table cuts the lineage, survives a lost executor, and is reread without a partitioning,
so that both sides of a later join are exchanged and skewed partitions can be split at run time.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's folder; a temporary one only on a local master without one (tests)."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpus-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


#: Rows reach a Python worker in batches of about so many bytes, long texts or short.
BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """For ``df.transform``: bounds the Arrow batches of the session by bytes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return df


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its task, beside the tasks of
    the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(batches: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The function of a ``mapInArrow``, giving memory back when its task ends."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from batches(it)
        finally:
            give_back()
    return run


def tidy_group(group: Callable[[pa.Table], pa.Table]):
    """The function of an ``applyInArrow``, giving memory back after each group."""
    def run(t: pa.Table) -> pa.Table:
        try:
            return group(t)
        finally:
            give_back()
    return run


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared folder, reread."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete a table that :func:`written` made and nothing reads any more."""
    spark = df.sparkSession
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/tables/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)
