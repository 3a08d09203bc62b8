"""Metric series and alarms over event tables (the original's dashboards and alarms, re-aimed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.operators.aggregations import r6


def bucket_start(ts: Column, period_s: int) -> Column:
    """Epoch second where the ``period_s`` bucket containing ``ts`` starts."""
    us = F.unix_micros(ts.cast("timestamp"))
    return (F.floor(us / F.lit(period_s * 1_000_000)) * period_s).cast("bigint")


def metric_series(events: DataFrame, source: str = "event_type", ts: str = "ts", value: str = "value",
                  period_s: int = 300) -> DataFrame:
    """Per source and period: count, sum and average of the value (one hash aggregate with partial
    aggregation, so a hot source costs one partial row per task and bucket)."""
    return (events.groupBy(F.col(source).alias("source"), bucket_start(F.col(ts), period_s).alias("bucket_start"))
            .agg(F.count(F.lit(1)).alias("n"), r6(F.sum(value)).alias("total_value"), r6(F.avg(value)).alias("avg_value")))


def alarm(series: DataFrame, statistic: str, threshold: float, periods: int, period_s: int) -> DataFrame:
    """Alarm buckets: the statistic is above ``threshold`` in ``periods`` consecutive buckets ending
    there. A missing bucket breaks the run (our rule). Each breach votes for the ``periods``
    buckets it could end; a bucket with ``periods`` votes closes a full run. Fully distributed:
    no ordered window over a whole source."""
    breach = series.filter(F.col(statistic) > F.lit(threshold)).select("source", "bucket_start")
    votes = breach.select("source", F.explode(F.sequence(
        F.col("bucket_start"), F.col("bucket_start") + F.lit((periods - 1) * period_s), F.lit(period_s))).alias("end"))
    runs = votes.groupBy("source", "end").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") == periods)
    return runs.select("source", F.col("end").alias("alarm_bucket_start"))


def alarms(series: DataFrame, rules: list[tuple], period_s: int) -> DataFrame:
    """(alarm, source, alarm_bucket_start) of several alarms; ``rules``: (name, source, statistic,
    threshold, periods). One pass over the series: a bucket breaches some of the rules, and votes for each."""
    names = F.array(*[F.when((F.col("source") == source) & (F.col(statistic) > F.lit(threshold)),
                             F.struct(F.lit(name).alias("alarm"), F.lit(periods).alias("periods")))
                      for name, source, statistic, threshold, periods in rules])
    breach = series.select("source", "bucket_start", F.explode(F.array_compact(names)).alias("r"))
    votes = breach.select("source", F.col("r.alarm").alias("alarm"), F.col("r.periods").alias("periods"), F.explode(F.sequence(
        F.col("bucket_start"), F.col("bucket_start") + (F.col("r.periods") - 1) * period_s, F.lit(period_s).cast("bigint"))).alias("end"))
    runs = votes.groupBy("alarm", "source", "end", "periods").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") == F.col("periods"))
    return runs.select("alarm", "source", F.col("end").alias("alarm_bucket_start"))


def daily_size(items: DataFrame, texts: list[str], created: str = "created_utc") -> DataFrame:
    """Objects and bytes of text per UTC day."""
    size = sum((F.octet_length(F.coalesce(F.col(c), F.lit(""))).cast("bigint") for c in texts), F.lit(0).cast("bigint"))
    return items.groupBy(F.to_date(F.timestamp_seconds(created)).alias("post_date")).agg(
        F.count(F.lit(1)).alias("n_objects"), F.sum(size).alias("n_bytes"))
