"""Registered queries: streams (drained with availableNow and compared with the batch result) and
monitoring rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from murmur import params as P
from murmur.operators import monitor as M
from murmur.operators import projections as PR
from murmur.plans import fixtures as X
from murmur.plans.catalog import query
from murmur.plans.oracle_sql import r6, with_items
from murmur.plans.q_enrich import PIPE_SCORED
from murmur.plans.q_io import ITEM_COLS, _raw_dir
from murmur.plans.q_relational import HASH_SQL, enriched, items
from murmur.plans.q_windows import QUOTA_LIMIT, QUOTA_SQL, request_log
from murmur.schema import ENRICHED, RAW_ITEM_FIELDS
from murmur.session import scratch_path
from murmur.sources import files, sinks
from murmur.sources.tables import table
from murmur.streaming import jobs as SJ

ING = X.INGEST
N_ARRIVALS = 6


def arrivals(df: DataFrame, time_col: str, path: str, run_once, fmt: str = "json", n: int = N_ARRIVALS,
             replay_first: bool = False) -> str:
    """Feed ``df`` to a file stream in ``n`` event-time slices: one parallel write stages every
    slice, then each slice is moved into the watched folder and the stream runs once with
    availableNow, restarting from its checkpoint, so every slice is one micro-batch in time order
    (optionally the first slice again at the end, as late data; it is copied first, in parallel). Slice bounds come
    from one min/max aggregate; no slice is funnelled through a single task."""
    lo, hi = df.agg(F.min(time_col), F.max(time_col)).first()
    width = (float(hi) - float(lo)) / n + 1e-6 if hi is not None else 1.0
    sl = F.least(F.floor((F.col(time_col).cast("double") - F.lit(float(lo or 0))) / F.lit(width)), F.lit(n - 1))
    staging, src, packed = f"{path}/staging", f"{path}/arrivals", "gzip" if fmt == "json" else "zstd"
    df.withColumn("_slice", sl.cast("int")).write.mode("overwrite").partitionBy("_slice").option("compression", packed).format(fmt).save(staging)
    spark = df.sparkSession
    order = list(range(n)) + ([0] if replay_first else [])
    for i, s in enumerate(order):
        at, to = f"{staging}/_slice={s}", f"{src}/arrival={i:04d}"
        if s in order[i + 1:] and sinks.path_exists(spark, at):  # comes again
            spark.read.schema(df.schema).format(fmt).load(at).write.option("compression", packed).format(fmt).save(to)
        else:
            sinks.move_folder(spark, at, to)
        run_once(src)
    return src


def _ts_num(col: str) -> F.Column:
    return F.unix_micros(F.col(col).cast("timestamp")).cast("double") / 1e6


@query("stm_enrich", with_items(
    "SELECT id, type, s_label AS sentiment_type, c_label AS classification FROM scored WHERE coalesce(txt, '') <> ''",
    PIPE_SCORED))
def q_stm_enrich(spark, sf):
    out = SJ.stm_enrich(files.raw_stream(spark, _raw_dir(spark, sf), max_files=2),
                        scratch_path(spark, "stm-enrich-out"), scratch_path(spark, "stm-enrich-ckpt"), lexicon=X.LEXICON, cues=X.CUES)
    e = spark.read.parquet(out)
    return e.select("id", "type", F.col("sentiment.Sentiment").alias("sentiment_type"),
                    F.col("content_type.Classification").alias("classification"))


@query("stm_hwm_late_drop", with_items(f"SELECT {', '.join(ITEM_COLS)} FROM items"))
def q_stm_hwm_late_drop(spark, sf):
    """Incremental ingestion over time-ordered arrivals plus a late replay of the first slice:
    the mark drops the replay, so every item is ingested exactly once."""
    from murmur.schema import RAW_ITEM
    it = items(spark, sf)
    it = it.select(*[c for c in RAW_ITEM_FIELDS if c in it.columns])
    out, mark, ckpt = scratch_path(spark, "hwm-out"), scratch_path(spark, "hwm-mark"), scratch_path(spark, "hwm-ckpt")

    def run_once(src):
        SJ.stm_hwm_ingest(spark.readStream.schema(RAW_ITEM).json(src), out, mark, ckpt, initial_mark=None)

    arrivals(it, "created_utc", scratch_path(spark, "arrivals-items"), run_once, replay_first=True)
    return spark.read.parquet(out).select(*ITEM_COLS)


@query("stm_daily_trend", with_items("SELECT post_date, sentiment_type, count(*) AS post_count FROM items GROUP BY 1, 2"))
def q_stm_daily_trend(spark, sf):
    """The trend over arrivals of which a third come days late, beyond any usual watermark."""
    e = enriched(spark, sf)
    out, ckpt = scratch_path(spark, "trend-out"), scratch_path(spark, "trend-ckpt")

    def run_once(src):
        SJ.drain_deltas(SJ.stm_daily_trend(spark.readStream.schema(ENRICHED).json(src)), out, ckpt, SJ.TREND_KEYS, SJ.TREND_SUMS, every=3)

    late = F.when(F.pmod(F.xxhash64("id"), F.lit(3)) == 0, 10 * 86400.0).otherwise(0.0)
    arrivals(e.withColumn("_arrives", F.col("created_utc") + late), "_arrives", scratch_path(spark, "arrivals-enriched"), run_once)
    return SJ.read_deltas(spark, out, SJ.TREND_KEYS, SJ.TREND_SUMS, StructType.fromDDL("post_date date, sentiment_type string"))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts_s", _ts_num("ts"))


@query("stm_quota", QUOTA_SQL)
def q_stm_quota(spark, sf):
    """The quota as a stream (keyed state) over request arrivals, one micro-batch per slice, restarting
    from the checkpoint each time; an hour's requests arrive in any order and a last heartbeat moves the
    watermark past them. Equals ``win_sliding_quota``."""
    log = request_log(spark, sf)
    out, ckpt = scratch_path(spark, "quota-out"), scratch_path(spark, "quota-ckpt")

    def run_once(src):
        SJ.stm_quota(spark.readStream.schema(log.schema).parquet(src), out, ckpt, "client", QUOTA_LIMIT, X.QUOTA_WINDOW, delay_s=7200.0)

    shuffled = log.withColumn("_arrives", F.col("ts_s") + F.pmod(F.xxhash64("event_id"), F.lit(3600)))
    src = arrivals(shuffled, "_arrives", scratch_path(spark, "arrivals-requests"), run_once, fmt="parquet")
    SJ.heartbeat(log, "ts_s", 3 * 7200.0).write.parquet(f"{src}/arrival=9999")
    run_once(src)
    return spark.read.parquet(out).select("event_id", "client", "ts_s", "accepted")


METRIC_SQL = (f"SELECT event_type AS source, cast(floor(epoch_us(ts) / 300000000) * 300 AS bigint) AS bucket_start, "
              f"count(*) AS n, {r6('sum(value)')} AS total_value, {r6('avg(value)')} AS avg_value FROM events GROUP BY 1, 2")


@query("stm_metric_window", METRIC_SQL)
def q_stm_metric_window(spark, sf):
    ev = _events(spark, sf)
    out, ckpt = scratch_path(spark, "metric-out"), scratch_path(spark, "metric-ckpt")

    def run_once(src):
        SJ.drain_deltas(SJ.stm_metric_window(spark.readStream.schema(ev.schema).parquet(src)), out, ckpt, SJ.METRIC_KEYS, SJ.METRIC_SUMS, every=4)

    late = F.when(F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0, 7200.0).otherwise(0.0)
    arrivals(ev.withColumn("_arrives", F.col("ts_s") + late), "_arrives", scratch_path(spark, "arrivals-events"), run_once, fmt="parquet")
    return SJ.metric_values(SJ.read_deltas(spark, out, SJ.METRIC_KEYS, SJ.METRIC_SUMS, StructType.fromDDL("source string, bucket_start bigint")))


@query("stm_dedup_ids", with_items("SELECT id, created_utc FROM items"))
def q_stm_dedup_ids(spark, sf):
    """``dedup_ids`` as a stream: every item arrives, and the items of one day arrive twice in one
    slice; within the watermark each id comes out once."""
    from murmur.streaming.files import drain_to_parquet
    it = items(spark, sf).select("id", "created_utc")
    twice = it.unionByName(it.filter(F.dayofmonth(F.timestamp_seconds("created_utc")) % 3 == 0))
    out, ckpt = scratch_path(spark, "dedup-out"), scratch_path(spark, "dedup-ckpt")

    def run_once(src):
        drain_to_parquet(SJ.stm_dedup(spark.readStream.schema(it.schema).parquet(src), ["id"]), out, ckpt)

    arrivals(twice, "created_utc", scratch_path(spark, "arrivals-ids"), run_once, fmt="parquet")
    return spark.read.parquet(out).select("id", "created_utc")


@query("stm_dedup_content", with_items(f"SELECT DISTINCT {HASH_SQL} AS content_hash FROM items"))
def q_stm_dedup_content(spark, sf):
    """``dedup_content`` as a stream: of items that arrive in the order of time, each hash comes out once
    in the span that the state remembers (here longer than the data)."""
    from murmur.streaming.files import drain_to_parquet
    it = PR.prj_content_hash(items(spark, sf)).select("id", "created_utc", "content_hash")
    out, ckpt = scratch_path(spark, "content-out"), scratch_path(spark, "content-ckpt")

    def run_once(src):
        drain_to_parquet(SJ.stm_dedup(spark.readStream.schema(it.schema).parquet(src), ["content_hash"], "400 days"), out, ckpt)

    arrivals(it, "created_utc", scratch_path(spark, "arrivals-content"), run_once, fmt="parquet")
    return spark.read.parquet(out).select("content_hash")


@query("mon_metric_series", METRIC_SQL)
def q_mon_metric_series(spark, sf):
    return M.metric_series(table(spark, sf, "events"), "event_type", "ts", "value", P.METRIC_PERIOD_SECONDS)


@query("mon_error_series", f"SELECT cast(floor(epoch_us(ts) / 300000000) * 300 AS bigint) AS bucket_start, count(*) AS n_errors "
                           f"FROM events WHERE event_type = 'error' GROUP BY 1")
def q_mon_error_series(spark, sf):
    """Error count per period."""
    e = table(spark, sf, "events").filter(F.col("event_type") == "error")
    return M.metric_series(e, "event_type", "ts", "value", P.METRIC_PERIOD_SECONDS).select("bucket_start", F.col("n").alias("n_errors"))


@query("mon_daily_size", with_items(
    "SELECT post_date, count(*) AS n_objects, cast(sum(strlen(coalesce(title, '')) + strlen(coalesce(selftext, '')) + strlen(coalesce(body, ''))) AS bigint) "
    "AS n_bytes FROM items GROUP BY 1"))
def q_mon_daily_size(spark, sf):
    """Objects and bytes of text per day."""
    return M.daily_size(items(spark, sf), ["title", "selftext", "body"])


# The four alarms with thresholds that the driver tables cross: (name, source, statistic, threshold, periods)
ALARMS = [(name, source, {"sum": "n", "avg": "avg_value"}[statistic], threshold, periods) for (name, statistic, _, periods), (source, threshold) in
          zip(P.ALARMS, [("error", 1.0), ("view", 60.0), ("purchase", 1.0), ("click", 40.0)])]


def _alarm_sql(name, source, statistic, threshold, periods):
    run = (f"SELECT a.b FROM s a WHERE a.source = '{source}' AND (SELECT count(*) FROM s c WHERE c.source = a.source AND c.{statistic} > {threshold} "
           f"AND c.b BETWEEN a.b - {(periods - 1) * P.METRIC_PERIOD_SECONDS} AND a.b) = {periods}")
    return f"SELECT '{name}' AS alarm, '{source}' AS source, b AS alarm_bucket_start FROM ({run})"


@query("mon_alarm",
       f"WITH s AS (SELECT source, bucket_start AS b, n, avg_value FROM ({METRIC_SQL})) " + " UNION ALL ".join(_alarm_sql(*a) for a in ALARMS))
def q_mon_alarm(spark, sf):
    """The deployed alarms over the metric series: each statistic above its threshold for its number
    of periods in a row."""
    series = M.metric_series(table(spark, sf, "events"), "event_type", "ts", "value", P.METRIC_PERIOD_SECONDS)
    return M.alarms(series, ALARMS, P.METRIC_PERIOD_SECONDS)
