"""File-stream plumbing: drain a stream into a table with an idempotent micro-batch sink."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame


def batch_writer(out_path: str, transform: Callable[[DataFrame], DataFrame] | None = None):
    """foreachBatch body: each micro-batch overwrites its own ``batch_id=N`` folder, so a replay of
    the same batch after a failure rewrites it instead of appending duplicates."""
    def write(df: DataFrame, batch_id: int) -> None:
        d = transform(df) if transform else df
        d.write.mode("overwrite").option("compression", "zstd").parquet(f"{out_path}/batch_id={batch_id}")
    return write


def drain_to_parquet(stream: DataFrame, out_path: str, checkpoint: str,
                     transform: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Run the stream over everything available now (several micro-batches), then stop."""
    q = (stream.writeStream.foreachBatch(batch_writer(out_path, transform))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path
