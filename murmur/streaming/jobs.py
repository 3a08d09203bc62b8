"""Structured Streaming forms of the pipeline: file-triggered enrichment, incremental ingestion
with a high-water mark, always-current rollups and the per-client request quota."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from murmur import params as P
from murmur.plans import jobs
from murmur.operators.aggregations import r6
from murmur.operators.windows import quota_segment
from murmur.sources.sinks import folder_names, path_exists, remove_folders
from murmur.streaming.files import batch_writer


def stm_enrich(raw: DataFrame, out_path: str, checkpoint: str, **scorers) -> str:
    """Each new raw file -> enriched rows (stateless; Catalyst scorers run inside the stream).
    ``scorers``: as for ``jobs.job_enrich``."""
    q = (jobs.job_enrich(raw, **scorers).writeStream.foreachBatch(batch_writer(out_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


# ------------------------------------------------------------------ incremental ingestion

def hwm_batch_writer(out_path: str, mark_path: str, initial_mark: float | None):
    """foreachBatch body keeping the high-water mark: rows strictly older than the mark are
    dropped as late; the batch is written, *then* its new mark is committed (at-least-once like
    the original; a replayed batch rewrites its own folder, and the mark is a max, so replays are
    harmless). The mark lives in a small table next to the checkpoint."""
    def current_mark(spark: SparkSession, batch_id: int) -> float | None:
        """The mark committed by the batches *before* this one, so replaying a batch after a
        failure sees the same mark as its first attempt."""
        if not path_exists(spark, mark_path):  # no mark written yet; any other failure stops the batch
            return initial_mark
        marks = spark.read.schema("mark double, batch_id bigint").parquet(mark_path).filter(F.col("batch_id") < batch_id)
        row = marks.agg(F.max("mark")).first()
        return row[0] if row and row[0] is not None else initial_mark

    def write(df: DataFrame, batch_id: int) -> None:
        mark = current_mark(df.sparkSession, batch_id)
        kept = df if mark is None else df.filter(F.col("created_utc") >= F.lit(mark))
        kept.write.mode("overwrite").option("compression", "zstd").parquet(f"{out_path}/batch_id={batch_id}")
        new = df.sparkSession.read.parquet(f"{out_path}/batch_id={batch_id}").agg(F.max("created_utc").alias("mark"))
        new.filter(F.col("mark").isNotNull()).write.mode("overwrite").parquet(f"{mark_path}/batch_id={batch_id}")
    return write


def stm_hwm_ingest(raw: DataFrame, out_path: str, mark_path: str, checkpoint: str,
                   initial_mark: float | None = None) -> str:
    q = (raw.writeStream.foreachBatch(hwm_batch_writer(out_path, mark_path, initial_mark))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


# ------------------------------------------------------------------ always-current aggregates

COMPACT_EVERY = 50


def _folders(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers n of the complete folders ``key=n`` under ``path``."""
    if not path_exists(spark, path):
        return []
    names = [n for n in folder_names(spark, path) if n.startswith(f"{key}=")]
    return sorted(int(n.partition("=")[2]) for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def _sums(rows: DataFrame, keys: list[str], sums: dict) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(kind).alias(c) for c, kind in sums.items()])


def delta_writer(out_path: str, keys: list[str], sums: dict, every: int = COMPACT_EVERY):
    """foreachBatch body for additive aggregates: each micro-batch leaves the sums of its own rows, signed
    changes that the reader adds up, so a row counts whenever it arrives, however late. Every
    ``every``-th batch first writes the sums of all batches before it (a base); the folders which that
    base holds are removed by a later batch, when the base's own batch is known to be committed. A
    replay finds all it read the first time and writes the same again."""
    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        bases = [n for n in _folders(spark, f"{out_path}/base", "upto") if n < batch_id]
        if bases:
            remove_folders(spark, f"{out_path}/base", "upto", before=bases[-1])
            if path_exists(spark, f"{out_path}/delta"):
                remove_folders(spark, f"{out_path}/delta", "batch_id", before=bases[-1])
        if batch_id and batch_id % every == 0 and path_exists(spark, f"{out_path}/delta"):
            read_deltas(spark, out_path, keys, sums, df.schema, before=batch_id).write.mode("overwrite").parquet(f"{out_path}/base/upto={batch_id}")
        _sums(df, keys, sums).write.mode("overwrite").parquet(f"{out_path}/delta/batch_id={batch_id}")
    return write


def read_deltas(spark: SparkSession, out_path: str, keys: list[str], sums: dict, schema, before: int | None = None) -> DataFrame:
    """The newest base and the deltas after it, added up (a partial aggregate). ``schema`` has the keys' types."""
    fields = ", ".join([*(f"{k} {schema[k].dataType.simpleString()}" for k in keys), *(f"{c} {kind}" for c, kind in sums.items())])
    bases = [n for n in _folders(spark, f"{out_path}/base", "upto") if before is None or n < before]
    since = bases[-1] if bases else 0
    rows = spark.read.schema(f"{fields}, batch_id bigint").parquet(f"{out_path}/delta").filter(F.col("batch_id") >= since)
    rows = (rows if before is None else rows.filter(F.col("batch_id") < before)).drop("batch_id")
    if bases:
        rows = rows.unionByName(spark.read.schema(fields).parquet(f"{out_path}/base/upto={since}"))
    return _sums(rows, keys, sums)


def drain_deltas(rows: DataFrame, out_path: str, checkpoint: str, keys: list[str], sums: dict, every: int = COMPACT_EVERY) -> str:
    q = (rows.writeStream.foreachBatch(delta_writer(out_path, keys, sums, every))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


TREND_KEYS, TREND_SUMS = ["post_date", "sentiment_type"], {"post_count": "bigint"}
METRIC_KEYS, METRIC_SUMS = ["source", "bucket_start"], {"n": "bigint", "total": "double", "cnt": "bigint"}


def stm_daily_trend(enriched_stream: DataFrame) -> DataFrame:
    """A count of one for each row, by day and sentiment: what ``drain_deltas`` adds up. There is no
    watermark, so no day is ever closed and no state grows; late rows correct their own day."""
    return enriched_stream.select(F.to_date(F.timestamp_seconds("created_utc")).alias("post_date"),
                                  F.col("sentiment.Sentiment").alias("sentiment_type"), F.lit(1).cast("bigint").alias("post_count"))


def stm_metric_window(events_stream: DataFrame, period_s: int = 300) -> DataFrame:
    """Tumbling-window metrics per source, as rows to add up."""
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (period_s * 1_000_000)) * period_s
    return events_stream.select(F.col("event_type").alias("source"), start.cast("bigint").alias("bucket_start"), F.lit(1).cast("bigint").alias("n"),
                                F.col("value").cast("double").alias("total"), F.col("value").isNotNull().cast("bigint").alias("cnt"))


def metric_values(sums: DataFrame) -> DataFrame:
    return sums.select("source", "bucket_start", "n", r6(F.col("total")).alias("total_value"), r6(F.col("total") / F.col("cnt")).alias("avg_value"))


# ------------------------------------------------------------------ request quota

#: Groups that clients are dealt to by a hash: a call and a state row each, however many clients there are.
#: A checkpoint holds for one number.
QUOTA_GROUPS = 1024


def _quota_states(id_col: str, key: str, limit: int, window_s: float):
    """applyInPandasWithState body for a group of clients. The state holds each client's accepted times that
    can still be in a window (at most ``limit``) and the requests later than the watermark; what the
    watermark has passed is judged in the order of time, whatever its order of arrival. Times of idle
    clients go when they have left the window, the group's state with the last of them."""
    def run(group, batches, state):
        kept_keys, kept_times, *waited = ([], [], [], [], []) if not state.exists else map(list, state.get)
        rows = [pdf.loc[pdf["_client"], [key, id_col, "ts_s"]] for pdf in batches]  # none on a timeout
        if waited and waited[0]:
            rows.insert(0, pd.DataFrame(dict(zip((key, id_col, "ts_s"), waited))))
        rows = [r for r in rows if len(r)]
        mark_ms = state.getCurrentWatermarkMs()
        mark = mark_ms / 1000.0
        kept: dict = {}
        for k, t in zip(kept_keys, kept_times):
            kept.setdefault(k, []).append(t)
        wait = pd.DataFrame({key: [], id_col: [], "ts_s": []})
        if rows:
            rows = pd.concat(rows, ignore_index=True)
            wait = rows[rows["ts_s"] > mark]
            due = rows[rows["ts_s"] <= mark].sort_values([key, "ts_s", id_col])
            if len(due):
                client, ts = due[key].to_numpy(), due["ts_s"].to_numpy(dtype="float64")
                accepted = np.zeros(len(due), dtype=bool)
                cuts = [0, *(np.flatnonzero(client[1:] != client[:-1]) + 1).tolist(), len(due)]
                for k, i, j in zip(due[key].iloc[cuts[:-1]].tolist(), cuts, cuts[1:]):
                    accepted[i:j], kept[k] = quota_segment(kept.get(k, []), ts[i:j], limit, window_s)
                yield due.assign(accepted=accepted)[[id_col, key, "ts_s", "accepted"]]
        # a second more than the window, for the rounding of times
        live = [(k, t) for k, times in kept.items() for t in times if t + window_s + 1.0 > mark]
        if not live and not len(wait):
            if state.exists:
                state.remove()
            return
        wake = float(wait["ts_s"].min()) if len(wait) else max(t for _, t in live) + window_s + 1.0
        state.update(([k for k, _ in live], [t for _, t in live], wait[key].tolist(), wait[id_col].tolist(), wait["ts_s"].tolist()))
        state.setTimeoutTimestamp(max(int(wake * 1000), mark_ms + 1))
    return run


def stm_quota(requests_stream: DataFrame, out_path: str, checkpoint: str, key: str = "user_id",
              limit: int = P.SEARCH_QUOTA_PER_HOUR, window_s: float = 3600.0, delay_s: float = 600.0, id_col: str = "event_id",
              groups: int = QUOTA_GROUPS) -> str:
    """The request quota as a stream (id, key, ts_s) with keyed state and event-time timeouts. Requests up
    to ``delay_s`` out of order get the verdict of the batch operator, once the watermark has passed
    them; a request later than that has no verdict and no influence (Spark counts it as dropped). Null
    keys are no clients (heartbeats; as a filter they would not reach the watermark). A client's pending
    requests are those of ``delay_s`` seconds; on a cluster with very many clients use the RocksDB state
    store. Clients are dealt to ``groups`` state rows by a hash, so that the calls of a micro-batch do not
    grow with the clients."""
    kinds = {f.name: f.dataType.simpleString() for f in requests_stream.schema.fields}
    # a heartbeat's nulls would turn the whole batch's integers into floats
    own = [F.when(F.col(key).isNull(), F.lit("0").cast(kinds[c])).otherwise(F.col(c)).alias(c) for c in (id_col, key)]
    timed = (requests_stream.withColumn("_ets", F.timestamp_seconds("ts_s")).withWatermark("_ets", f"{delay_s} seconds")
             .select(*own, "ts_s", "_ets", F.col(key).isNotNull().alias("_client"), F.pmod(F.xxhash64(key), F.lit(groups)).alias("_group")))
    judged = timed.groupBy("_group").applyInPandasWithState(
        _quota_states(id_col, key, limit, window_s), f"{id_col} {kinds[id_col]}, {key} {kinds[key]}, ts_s double, accepted boolean",
        f"kept_keys array<{kinds[key]}>, kept array<double>, keys array<{kinds[key]}>, ids array<{kinds[id_col]}>, times array<double>",
        "append", GroupStateTimeout.EventTimeTimeout)
    q = (judged.writeStream.outputMode("append").foreachBatch(batch_writer(out_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def heartbeat(rows: DataFrame, ts: str, after_s: float) -> DataFrame:
    """One row without a key, ``after_s`` seconds after the last of ``rows``: it moves the watermark of a
    source that has fallen silent."""
    last = rows.agg((F.max(ts) + F.lit(after_s)).alias(ts))
    return last.select(*[F.col(ts) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields])


# ------------------------------------------------------------------ deduplication

def stm_dedup(stream: DataFrame, keys: list[str], delay: str = "1 day") -> DataFrame:
    """First row per key within the watermark: state holds keys for ``delay``, not for ever."""
    return (stream.withColumn("_ets", F.timestamp_seconds("created_utc")).withWatermark("_ets", delay)
            .dropDuplicatesWithinWatermark(keys).drop("_ets"))
