"""Session helpers: local sessions for tests/bench, runtime settings and a shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on. They are session-scoped and safe to set on a
# session someone else built (the driver's, a notebook's, a cluster job's).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",  # epoch seconds -> UTC days, like the hosted SQL engine
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, cpus: int | None = None, app: str = "murmur",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local session for tests and bench. On a cluster, use the session the platform hands you."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("MURMUR_DRIVER_MEMORY", "16g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true"))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; only when unset (tests, local runs)
    is a private one created and registered."""
    sc = spark.sparkContext
    d = None
    try:
        d = sc.getCheckpointDir()
    except Exception:  # older API surface
        d = None
    d = d or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder every executor can reach")
        d = tempfile.mkdtemp(prefix="murmur-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local on a cluster)."""
    return f"{checkpoint_root(spark)}/murmur/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def batch_bytes(spark: SparkSession, most: int):
    """Arrow batches of at most ``most`` bytes (or of one longer row) in the jobs run inside."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, f"{most}b")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def cut_lineage(df):
    """Materialise a *bounded* intermediate that several branches reuse (accepted posts, their
    comments, a confusion table): a reliable checkpoint into the shared checkpoint folder, so the
    big scans behind it run once and a lost executor re-reads the files instead of recomputing."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
